"""Document fingerprints by order MinHash.

A text is cut into pieces (runs of up to 8 characters between white space), and a k-mer is a piece with the next ones.
Equal k-mers of a text are numbered by occurrence, and the hash of k-mer and number decides: it deals the k-mer to one of
``BINS`` bins, and the ``LEAST`` smallest hashes of a bin are selected. They are put back into the order of the text, and
the hash of that tuple is the bin's part of the signature. Two texts agree in a bin only if they agree on the k-mers and on
their order, so the share of agreeing bins falls with edit distance, also where the sets of k-mers are equal.

All of it is array expressions. A k-mer hash and its position share one long, so sorting is sorting of longs, and the
number of an occurrence follows from a binary search in the sorted hashes.

The next document is found without a global sort: rows are dealt to ranges of doc_id, and the first row of each range is
also given to the range before it as a guard.

NULL texts count as empty. An empty text has no k-mers; two empty texts are alike. Rows without a doc_id come last;
rows with the same doc_id follow each other by a key of the text. A single document is its own next one. An empty table
gives no rows. Extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.common import n_parts, text_key, whole_text

PIECE = r"[^\x20\x09-\x0D]{1,8}"
K = 3
BINS, BIN_BITS = 64, 6
LEAST = 2
POSITION = (1 << 24) - 1  # low bits of a packed k-mer: where it begins
EMPTY = "-" * 8
RANGE = 8 * 1024 * 1024  # bytes of text per range of doc_id, about
MOST_RANGES = 1000
STEPS = tuple(1 << i for i in range(23, -1, -1))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once; inside a lambda Spark works expressions out per element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _kmers(pieces: Column) -> Column:
    """One long per position: the hash of the k-mer that begins there above, the position below."""

    def packed(h: Column) -> Column:
        def at(x: Column, i: Column) -> Column:
            kmer = F.xxhash64(x, *[F.get(h, i + j) for j in range(1, K)])
            return kmer.bitwiseAND(F.lit(~POSITION)).bitwiseOR(i.cast("long").bitwiseAND(F.lit(POSITION)))

        return F.transform(h, at)

    return _let(F.transform(pieces, lambda p: F.xxhash64(p)), packed)


def _numbered(ordered: Column) -> Column:
    """The hash of each k-mer with the number of its occurrence, the position again below."""

    def at(x: Column, i: Column) -> Column:
        def same(j: Column) -> Column:
            return F.coalesce(F.get(ordered, j).bitwiseAND(F.lit(~POSITION)) == x.bitwiseAND(F.lit(~POSITION)), F.lit(False))

        def further(back: Column, step: Column) -> Column:
            return F.when(same(i - back - step), back + step).otherwise(back)

        earlier = F.when(same(i - 1), F.aggregate(F.array(*[F.lit(s) for s in STEPS]), F.lit(0), further)).otherwise(0)
        return F.xxhash64(F.shiftright(x, 24), earlier).bitwiseAND(F.lit(~POSITION)).bitwiseOR(x.bitwiseAND(F.lit(POSITION)))

    return F.transform(ordered, at)


def _signature(kmers: Column, selected: Column, bins: Column) -> Column:
    def of(b: Column) -> Column:
        def tuple_of(first: Column) -> Column:
            there = [F.when(F.get(bins, first + j) == b, F.get(selected, first + j).bitwiseAND(F.lit(POSITION)).cast("int")) for j in range(LEAST)]
            in_order = F.array_sort(F.filter(F.array(*there), lambda p: p.isNotNull()))
            contents = F.transform(in_order, lambda p: F.shiftright(F.get(kmers, p), 24))
            return F.lower(F.lpad(F.hex(F.xxhash64(contents).bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))

        first = (F.array_position(bins, b) - 1).cast("int")
        return _let(first, lambda f: F.when(f < 0, F.lit(EMPTY)).otherwise(tuple_of(f)))

    return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(BINS - 1).cast("long")), of), "")


def fingerprint(text: Column) -> Column:
    """BINS times eight characters; equal texts have equal fingerprints."""

    def of_kmers(kmers: Column) -> Column:
        return _let(
            F.sort_array(_let(F.sort_array(kmers), _numbered)),
            lambda s: _let(F.transform(s, lambda x: F.shiftrightunsigned(x, 64 - BIN_BITS)), lambda b: _signature(kmers, s, b)),
        )

    return _let(_let(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), _kmers), of_kmers)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bins among those that are not empty on both sides; 1 for two texts without k-mers."""
    at = F.sequence(F.lit(1), F.lit(8 * (BINS - 1) + 1), F.lit(8))
    pairs = F.transform(at, lambda i: F.struct(a.substr(i, F.lit(8)).alias("a"), b.substr(i, F.lit(8)).alias("b")))
    used = F.filter(pairs, lambda p: (p["a"] != EMPTY) | (p["b"] != EMPTY))
    return _let(used, lambda u: F.when(F.size(u) == 0, 1.0).otherwise(F.size(F.filter(u, lambda p: p["a"] == p["b"])) / F.size(u)))


def _with_next(docs: DataFrame, text: str) -> DataFrame:
    """doc_id, text, fingerprint and the same of the next document by falling doc_id (after the last: the first)."""
    grid = [i / MOST_RANGES for i in range(1, MOST_RANGES)]
    known = docs.agg(F.sum(F.octet_length(text)).alias("n"), F.percentile_approx("doc_id", grid, 10_000).alias("grid")).first()
    n = min(n_parts(known.n or 0, RANGE), MOST_RANGES)
    bounds = sorted({known.grid[i * MOST_RANGES // n - 1] for i in range(1, n)}) if known.grid else []
    above = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in bounds]), lambda x: x > F.col("doc_id"))) if bounds else F.lit(0)
    rows = docs.select(
        "doc_id",
        F.when(F.col("doc_id").isNull(), n + 1).otherwise(above).cast("int").alias("range"),
        F.bitwise_not("doc_id").alias("falling"),
        text_key(text).alias("key"),
        whole_text(text).alias("text"),
    )
    # At most MOST_RANGES + 1 rows of three numbers, so they may be sent everywhere.
    heads = rows.groupBy("range").agg(F.min(F.struct("falling", "key")).alias("head"))
    around = Window.partitionBy().orderBy("range")
    before = F.coalesce(F.lag("range").over(around), F.max("range").over(Window.partitionBy()))
    heads = heads.select(F.col("range").alias("_range"), F.col("head.falling").alias("_falling"), F.col("head.key").alias("_key"), before.alias("before"))
    is_head = (F.col("range") == F.col("_range")) & F.col("falling").eqNullSafe(F.col("_falling")) & (F.col("key") == F.col("_key"))
    rows = rows.join(F.broadcast(heads), is_head, "left")
    own, guard = F.struct("range", F.lit(0).alias("guard")), F.struct(F.col("before").alias("range"), F.lit(1).alias("guard"))
    places = F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, guard)))
    rows = rows.withColumn("print", fingerprint(F.col("text")))
    rows = rows.select("doc_id", "falling", "key", "text", "print", places.alias("place"))
    rows = rows.select("doc_id", "falling", "key", "text", "print", "place.range", "place.guard")
    following = Window.partitionBy("range").orderBy("guard", "falling", "key")
    rows = rows.withColumn("next", F.lead("text").over(following)).withColumn("next_print", F.lead("print").over(following))
    return rows.where(F.col("guard") == 0).select("doc_id", "text", "print", "next", "next_print")


def compared(docs: DataFrame, text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document, and how alike they are."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next", F.lit(1), half))
    rows = _with_next(docs, text).select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "print", "next_print")
    rows = rows.withColumn("edited_print", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("print").alias("fingerprint"),
        F.col("edited_print").alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
