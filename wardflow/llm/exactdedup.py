"""Exact dedup by an exchange of Golomb-coded fingerprints.

The normalised texts are written once, in blocks of at most ``BLOCK`` rows, as a table bucketed by block. Whatever belongs
to a block meets its rows there without a shuffle of texts:

1. every block sends its distinct fingerprints, sorted and Golomb-coded, to the owners of their ranges;
2. every owner finds the fingerprints that came from several blocks and answers each block with a bitmap;
3. the block joins the bitmaps with what it finds twice in itself: the suspects;
4. only the texts of suspects are shuffled, once per block and text, and compared byte by byte.

Fingerprints are long enough that about one row in 65,536 is suspected for nothing; such a row ends as a class of its own.
A text that a third of all rows share crosses the network once per block.

Texts are equal when they are identical after every run of [\\x20\\x09-\\x0D] became one space; NULL counts as the empty
text, and a text of blanks is one space, which is not empty. Rows without a doc_id come after all others; of rows with
the same smallest doc_id the first one written stays, so every class keeps exactly one row. Texts of any length take
part whole. An empty table gives no rows. Columns other than the id and the text are read only by ``deduplicated``, which
returns them whatever their names.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import n_parts, staged, whole_text
from wardflow.session import new_workspace

BLOCK = 2**20  # rows of a block at most; a task begins a new one
BUCKET = 16 * 1024 * 1024  # bytes of text in a bucket, about
OWNER = 2_000_000  # fingerprints of an owner, about
SLACK = 16  # bits of a fingerprint beyond those that number the rows

_HEAD = np.dtype([("n", "<u4"), ("low", "<u4"), ("unary", "<u4")])


def normalised(text: str = "text"):
    """The text with every run of blanks as one space."""
    return F.regexp_replace(whole_text(text), r"[\x20\x09-\x0D]+", " ")


# --- Golomb codes of sorted numbers ---


def golomb(values: np.ndarray, low: int) -> bytes:
    """Gaps between ascending distinct numbers: the lowest ``low`` bits as they are, the rest in unary, as two streams."""
    gaps = np.diff(values, prepend=0)
    high = gaps >> low
    ends = np.cumsum(high + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 1
    rest = ((gaps[:, None] >> np.arange(low)) & 1).astype(np.uint8)
    return np.array([(len(values), low, len(unary))], _HEAD).tobytes() + np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def from_golomb(code: bytes) -> np.ndarray:
    n, low, length = (int(x) for x in np.frombuffer(code, _HEAD, 1)[0])
    body = np.frombuffer(code, np.uint8, offset=_HEAD.itemsize)
    cut = -(-length // 8)
    high = np.diff(np.flatnonzero(np.unpackbits(body[:cut], count=length)), prepend=-1) - 1
    rest = np.unpackbits(body[cut:], count=n * low).reshape(n, low).astype(np.int64)
    return np.cumsum((high << low) + (rest << np.arange(low)).sum(axis=1))


def low_bits(span: int, n: int) -> int:
    """The best parameter for n numbers spread over a span: the power of two nearest to 0.69 times the usual gap."""
    return max(0, int(0.69 * math.sqrt(2) * span / max(n, 1)).bit_length() - 1)


def _words_of(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, the first bit lowest."""
    return np.packbits(np.pad(bits, (0, -len(bits) % 64)), bitorder="little").view(np.int64)


def _bits_of(words: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(words.astype(np.int64).view(np.uint8), bitorder="little", count=n).astype(bool)


class Ranges:
    """Which owner has which fingerprints; a fingerprint is the head of the 64-bit hash of the text."""

    def __init__(self, n_rows: int):
        self.bits = min(63, max(n_rows, 1).bit_length() + SLACK)
        self.n_owners = n_parts(n_rows, OWNER)
        self.width = -(-(2**self.bits) // self.n_owners)

    def prints(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64)

    def parts(self, distinct: np.ndarray) -> Iterable[tuple[int, int, int]]:
        """Owner, first and end of the stretch it owns, for every owner of one of the sorted fingerprints."""
        owner = distinct // self.width
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        return zip(owner[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(distinct)], strict=True)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def coded(ranges: Ranges) -> Callable[[pa.Table], pa.Table]:
    """Of the hashes of a block: owner and code of the distinct fingerprints of its range."""

    def run(rows: pa.Table) -> pa.Table:
        distinct = np.unique(ranges.prints(_column(rows, "h")))
        owners, codes = [], []
        for owner, a, b in ranges.parts(distinct):
            owners.append(owner)
            codes.append(golomb(distinct[a:b] - owner * ranges.width, low_bits(ranges.width, b - a)))
        block = pa.array(np.full(len(owners), _column(rows, "block")[0]), pa.int64())
        return pa.table({"block": block, "owner": pa.array(owners, pa.int32()), "code": pa.array(codes, pa.binary())})

    return run


def answered(codes: pa.Table) -> pa.Table:
    """For every block that wrote to an owner: which of its fingerprints, in order, another block sent as well."""
    lists = [from_golomb(c) for c in codes.column("code").to_pylist()]
    lengths = [len(x) for x in lists]
    _, place, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = (count > 1)[place]
    cuts = np.cumsum(lengths)[:-1]
    maps = [_words_of(part) for part in np.split(shared, cuts)]
    return pa.table({"block": codes.column("block"), "owner": codes.column("owner"), "bits": pa.array(maps, pa.list_(pa.int64()))})


def flagged(ranges: Ranges) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One row per block: a bitmap over its rows, set for suspects."""

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        distinct, place, count = np.unique(ranges.prints(_column(rows, "h")), return_inverse=True, return_counts=True)
        suspect = count > 1
        by_owner = dict(zip(answers.column("owner").to_pylist(), answers.column("bits"), strict=True))
        for owner, a, b in ranges.parts(distinct):
            suspect[a:b] |= _bits_of(by_owner[owner].values.to_numpy(), b - a)
        pos = _column(rows, "pos")
        bits = np.zeros(int(pos.max()) + 1, bool)
        bits[pos] = suspect[place]
        block = pa.array(_column(rows, "block")[:1], pa.int64())
        return pa.table({"block": block, "flags": pa.array([_words_of(bits)], pa.list_(pa.int64()))})

    return run


def _classified(docs: DataFrame, carried: list[str], text: str, id_column: str) -> DataFrame:
    """Columns doc (a struct of the carried columns), sha, keep_id, group_size, kept for every row of ``docs``."""
    spark = docs.sparkSession
    n_rows, n_bytes = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    ranges, n_buckets = Ranges(n_rows), n_parts(n_bytes, BUCKET)

    numbered = docs.select(F.struct(*carried).alias("doc"), F.col(id_column).alias("id"), normalised(text).alias("norm"), F.monotonically_increasing_id().alias("_n"))
    rows = numbered.select(
        F.shiftright("_n", 20).alias("block"),
        F.col("_n").bitwiseAND(BLOCK - 1).cast("int").alias("pos"),
        "doc",
        "id",
        F.xxhash64("norm").alias("h"),
        F.sha2("norm", 256).alias("sha"),
        "norm",
    )
    path, name = new_workspace(spark, "exact"), f"wardflow_exact_{uuid.uuid4().hex}"
    # Bucketed tables need a name; it goes again once the suspects are known, the files stay.
    rows.write.bucketBy(n_buckets, "block").option("path", path).option("compression", "zstd").saveAsTable(name)
    try:
        blocks = spark.table(name)
        codes = blocks.select("block", "h").groupBy("block").applyInArrow(coded(ranges), "block long, owner int, code binary")
        answers = codes.groupBy("owner").applyInArrow(answered, "block long, owner int, bits array<bigint>")
        flags = staged(
            blocks.select("block", "pos", "h").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(flagged(ranges), "block long, flags array<bigint>"),
            "flags",
        )
        suspects = blocks.join(flags.hint("shuffle_hash"), "block").where("getbit(flags[pos div 64], pos % 64) = 1")
        first = F.min(F.struct(F.col("id").isNull(), "id", "block", "pos")).alias("first")
        in_block = suspects.groupBy("block", "sha", "norm").agg(first, F.count(F.lit(1)).alias("n"))
        # One exchange serves both: bytes are compared within a digest, and a digest with two texts would be an error.
        texts = in_block.repartition("sha").groupBy("sha", "norm").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
        classes = texts.groupBy("sha").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
        classes = staged(
            classes.select("sha", "first", F.when(F.col("texts") == 1, F.col("n")).otherwise(F.raise_error(F.lit("two texts with one SHA-256"))).alias("n")),
            "classes",
        )
        members = staged(suspects.select("block", "sha").distinct().join(classes, "sha"), "members")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    # A class reaches its rows block by block, so no key of this join has more rows than a block.
    narrow = spark.read.schema(rows.schema).parquet(path).select("block", "pos", "doc", "id", "sha")
    alone = F.col("n").isNull()
    stays = (F.col("first.block") == F.col("block")) & (F.col("first.pos") == F.col("pos"))
    return narrow.join(members, ["block", "sha"], "left").select(
        "doc",
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | stays).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The id of every row, the id of the row of its class that stays, the size of the class, and whether it is that row."""
    out = _classified(docs, [id_column], text, id_column)
    return out.select(F.col(f"doc.{id_column}").alias(id_column), "keep_id", "group_size", "kept", "text_sha256")


def deduplicated(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, one per class, with all their columns."""
    return _classified(docs, docs.columns, text, id_column).where("kept").select("doc.*")
