"""N-gram Jaccard join with vertical partitioning.

A document's set of word n-grams is a set of 64-bit hashes, whose order is the global n-gram order. It is cut into
fragments of equal length. Every task sends each fragment the part of its sets that falls into it, so a fragment sees all
occurrences of its n-grams and knows how many different sets hold each of them. N-grams of one set only can be in no
overlap and end there; what comes out are partial sets of shared n-grams with their frequencies.

Sets that share too few n-grams to link with anything are dropped exactly (count filter over all fragments). For the
others, candidates share an n-gram of their prefixes in the order of (frequency, hash), rarest first. A candidate pair is
counted fragment by fragment, and the partial overlaps are summed per pair.

Copies never multiply: equal sets are one class, named by a digest of the set. Of very similar sets not every pair is
counted either, because only the components are asked for: in each prefix list, all sets are first held against one
centre, and after that only pairs that still lie in different components are left to be counted, all of them. Before
anything is counted, two exact bounds are held against a pair: what can still be common from the place of a shared n-gram
on, and the least difference of the sets that the parities of their hashes show.

NULL or empty texts have no n-grams and link with nothing. Rows without a doc_id take part; a component of such rows only
has no id. Rows with the same doc_id are documents of their own. An empty table gives no rows. Extra columns are never
read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.common import chunks, mixed, n_parts, release_kept, run_hashes, staged, text_bytes, text_key, whole_text, word_hashes
from wardflow.llm.components import components
from wardflow.llm.superkmers import order_of

N = 4
PERCENT = 85
FRAGMENT = 2_500_000  # n-grams per fragment, at most about
FRAGMENTS = 64  # fragments at least
FLUSH = 1_500_000  # n-grams a task gathers before it sends them
PARTS = 8  # groups of fragments in which the overlap of a pair is counted
CENTRES = 1  # rounds against centres before all pairs between components are counted
PARITIES = 512  # bits of the parity map of a set
HASH_BITS, TOKEN_BITS = 48, 44


def _sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted n-gram hashes of each text; shorter texts have their whole sequence as one."""
    for a, b in chunks(offsets):
        words, _, _, first = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower=True)
        runs = run_hashes(words, n)
        for x, y in zip(first.tolist(), first[1:].tolist(), strict=False):
            if y - x >= n:
                yield np.unique(runs[x : y - n + 1])
            elif y > x:
                yield mixed(run_hashes(words[x:y], y - x) + np.uint64(y - x))
            else:
                yield np.zeros(0, np.uint64)


def _digest(grams: np.ndarray) -> int:
    """A signed 64-bit name of a set, whatever the order of its members."""
    total = np.array([mixed(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64), mixed(grams).sum(dtype=np.uint64), len(grams)], np.uint64)
    return int(run_hashes(total, 3).view(np.int64)[0])


def _parities(grams: np.ndarray) -> np.ndarray:
    """Bits that tell for each remainder whether an odd number of hashes has it. Sets that differ in k hashes differ in
    k bits at most."""
    odd = np.bincount((grams % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def members(docs: DataFrame, text: str = "text", n: int = N) -> DataFrame:
    """ord, key, doc_id, n_shingles, class, parity map of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        for batch in batches:
            sizes, names, bits = [], [], []
            for grams in _sets(*text_bytes(batch.column(3)), n):
                sizes.append(len(grams))
                names.append(_digest(grams) if len(grams) else None)
                bits.append(_parities(grams))
            columns = [pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(bits, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names=["ord", "key", "doc_id", "n_shingles", "class", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(order_of().alias("ord"), text_key(text).alias("key"), "doc_id", whole_text(text).alias("_text"))
    return rows.mapInArrow(run, f"ord long, key long, doc_id {kind}, n_shingles long, class long, bits array<long>")


def shared_parts(docs: DataFrame, n_fragments: int, text: str = "text", n: int = N) -> DataFrame:
    """class, part, grams (array), counts (array): the n-grams of each class that other classes have too."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        found: dict[int, np.ndarray] = {}
        size = 0

        def flushed() -> pa.RecordBatch:
            names = np.fromiter(found, np.int64, len(found))
            owner = np.repeat(np.arange(len(names)), [len(g) for g in found.values()])
            grams = np.concatenate(list(found.values()))
            fragment = ((grams >> np.uint64(32)) * np.uint64(n_fragments) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(fragment, kind="stable")
            cuts = np.searchsorted(fragment[order], np.arange(n_fragments + 1))
            ids, payloads = [], []
            for i in np.flatnonzero(np.diff(cuts)).tolist():
                mine = order[cuts[i] : cuts[i + 1]]
                whose, counts = np.unique(owner[mine], return_counts=True)
                low = (grams[mine] >> np.uint64(64 - 8 - HASH_BITS)).view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8]
                ids.append(i)
                payloads.append(pickle.dumps((names[whose], counts.astype(np.int32), low.tobytes()), protocol=5))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(payloads, pa.binary())], names=["fragment", "payload"])

        for batch in batches:
            for grams in _sets(*text_bytes(batch.column(0)), n):
                if len(grams) and (name := _digest(grams)) not in found:
                    found[name] = grams
                    size += len(grams)
                    if size > FLUSH:
                        yield flushed()
                        found, size = {}, 0
        if found:
            yield flushed()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        waiting: list[bytes] = []
        current = None
        for batch in batches:
            for fragment, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if fragment != current and waiting:
                    yield from counted(current, waiting)
                    waiting = []
                current = fragment
                waiting.append(payload)
        if waiting:
            yield from counted(current, waiting)

    def counted(fragment: int, payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        loaded = [pickle.loads(p) for p in payloads]
        payloads.clear()
        names = np.concatenate([x[0] for x in loaded])
        sizes = np.concatenate([x[1] for x in loaded])
        low = np.frombuffer(b"".join(x[2] for x in loaded), np.uint8).reshape(-1, HASH_BITS // 8)
        del loaded
        grams = np.zeros((len(low), 8), np.uint8)
        grams[:, : HASH_BITS // 8] = low
        grams = grams.view(np.int64).ravel()
        # A class that several tasks sent counts once.
        _, first = np.unique(names, return_index=True)
        once = np.zeros(len(names), bool)
        once[first] = True
        grams = grams[np.repeat(once, sizes)]
        names, sizes = names[once], sizes[once]
        owner = np.repeat(np.arange(len(names), dtype=np.int32), sizes)
        order = np.argsort(grams, kind="stable")
        ordered = grams[order]
        heads = np.flatnonzero(np.diff(ordered, prepend=-1))
        runs = np.diff(np.append(heads, len(ordered)))
        counts = np.repeat(runs, runs)
        shared = counts > 1
        at, counts = order[shared], counts[shared]
        back = np.argsort(at, kind="stable")  # by class again, as they came
        at, counts = at[back], counts[back]
        whose, n_each = np.unique(owner[at], return_counts=True)
        values = grams[at] ^ (np.int64(fragment) << np.int64(HASH_BITS))
        ends = np.concatenate([[0], np.cumsum(n_each)])
        for i in range(0, len(whose), 2000):
            j = min(len(whose), i + 2000)
            offsets = pa.array(ends[i : j + 1] - ends[i], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[whose[i:j]]),
                    pa.array(np.full(j - i, fragment % PARTS, np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(values[ends[i] : ends[j]])),
                    pa.ListArray.from_arrays(offsets, pa.array(counts[ends[i] : ends[j]], pa.int32())),
                ],
                names=["class", "part", "grams", "counts"],
            )

    sent = docs.select(whole_text(text).alias("_text")).mapInArrow(send, "fragment int, payload binary")
    placed = sent.repartition(n_fragments, "fragment").sortWithinPartitions("fragment")
    return placed.mapInArrow(count, "class long, part int, grams array<long>, counts array<int>")


def _least_overlap(size: str, percent: int) -> Column:
    """Shared n-grams that a set of this size needs with any partner, at least."""
    return F.ceil(F.col(size) * percent / 100)


def _links(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) that link: overlaps are counted per part and summed per pair."""
    left = parts.select(F.col("class").alias("a"), "part", F.col("grams").alias("_x"))
    right = parts.select(F.col("class").alias("b"), "part", F.col("grams").alias("_y"))
    partial = F.size(F.array_intersect("_x", "_y"))
    counted = pairs.join(left, "a").join(right, ["b", "part"]).groupBy("a", "b", "na", "nb").agg(F.sum(partial).alias("both"))
    return counted.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b")


def _may_link(percent: int) -> Column:
    """Whether a set and its partner in a list (columns with an underscore) may link, by their sizes, by the place of the
    n-gram they share, and by their parity maps. The bounds hold for the first n-gram a linked pair shares."""
    total = F.col("n") + F.col("_n")
    needed = F.ceil(total * percent / (100 + percent))
    differ = sum((F.bit_count(F.get("bits", F.lit(i)).bitwiseXOR(F.get("_bits", F.lit(i)))) for i in range(PARITIES // 64)), F.lit(0))
    return (F.least(F.col("n") - F.col("pos"), F.col("_n") - F.col("_pos")) >= needed) & (differ <= total - 2 * needed)


def _partner(lists: DataFrame, *keep: str) -> DataFrame:
    return lists.select(*keep, *[F.col(c).alias(f"_{c}") for c in ("class", "n", "pos", "bits", "comp")])


def _centre_pairs(lists: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each set of a list against one set of the list of about its size, if they lie in different components. The centre
    is the set with the smallest share of n-grams of its own, which most others are closest to."""
    rank = F.struct((F.col("alone") / F.col("n")).alias("share"), F.xxhash64("class", F.lit(turn)).alias("o"), "class", "n", "pos", "bits", "comp")
    centres = lists.groupBy("token", "band").agg(F.min(rank).alias("c")).select("token", "band", "c.*")
    met = lists.join(_partner(centres, "token", "band"), ["token", "band"]).where((F.col("comp") != F.col("_comp")) & _may_link(percent))
    return _ordered(met)


def _other_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs of sets of a list that lie in different components.

    The largest component of a list is one side only, so a list costs what lies outside of it times its length.
    """
    sizes = lists.groupBy("token", "comp").agg(F.count("*").alias("_m"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("_m", "comp"))["comp"].alias("_main"))
    outside = lists.join(largest, "token").where(F.col("comp") != F.col("_main"))
    mine = outside.select("token", "_main", "class", "n", "pos", "bits", "comp", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    apart = (F.col("comp") != F.col("_comp")) & ((F.col("_comp") == F.col("_main")) | (F.col("class") < F.col("_class")))
    return _ordered(mine.join(_partner(lists, "token", "band"), ["token", "band"]).where(apart & _may_link(percent)))


def _ordered(met: DataFrame) -> DataFrame:
    swap = F.col("class") > F.col("_class")
    pairs = met.select(
        F.least("class", "_class").alias("a"),
        F.greatest("class", "_class").alias("b"),
        F.when(swap, F.col("_n")).otherwise(F.col("n")).alias("na"),
        F.when(swap, F.col("n")).otherwise(F.col("_n")).alias("nb"),
    )
    return pairs.distinct()


def class_components(docs: DataFrame, known: DataFrame, text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """node, comp: the component of every class that links with another class."""
    total = known.agg(F.sum("n_shingles")).first()[0] or 0
    parts = staged(shared_parts(docs, max(FRAGMENTS, n_parts(total, FRAGMENT)), text, n), "shared-grams")
    sizes = known.where("n_shingles > 0").groupBy("class").agg(F.max("n_shingles").alias("n"), F.min("bits").alias("bits"))
    shared = parts.groupBy("class").agg(F.sum(F.size("grams")).alias("shared"))
    able = staged(shared.join(sizes, "class").where(F.col("shared") >= _least_overlap("n", percent)), "candidates")
    # Rarest first; the n-grams that no other class has come before all of these and take up a part of the prefix.
    token = F.transform(F.arrays_zip("grams", "counts"), lambda x: F.shiftleft(F.least(x["counts"], F.lit(1 << 18)).cast("long"), TOKEN_BITS) + x["grams"].bitwiseAND(F.lit((1 << TOKEN_BITS) - 1)))
    own = parts.join(able.drop("bits"), "class")
    whole = own.select("class", "n", "shared", token.alias("tokens")).groupBy("class", "n", "shared").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))
    prefix = F.slice(F.sort_array("tokens"), F.lit(1), (F.col("shared") - _least_overlap("n", percent) + 1).cast("int"))
    alone = F.col("n") - F.col("shared")
    postings = whole.select("class", "n", alone.alias("alone"), F.floor(F.log("n") / np.log(100 / percent)).cast("int").alias("band"), F.posexplode(prefix).alias("pos", "token"))
    # A place counts the n-grams before it, those of the set alone included.
    postings = postings.withColumn("pos", F.col("pos") + F.col("alone")).join(able.select("class", "bits"), "class")
    postings = staged(postings, "prefixes")
    parts = staged(own.groupBy("class", "part").agg(F.flatten(F.collect_list("grams")).alias("grams")), "candidate-grams")
    links = tested = None
    labels = None
    for turn in range(CENTRES + 1):
        rows = postings
        if labels is None:
            rows = rows.withColumn("comp", F.col("class"))
        else:
            rows = rows.join(labels.select(F.col("node").alias("class"), "comp"), "class", "left").withColumn("comp", F.coalesce("comp", "class"))
        spread = rows.groupBy("token").agg((F.min("comp") < F.max("comp")).alias("several")).where("several").select("token")
        lists = staged(rows.join(spread, "token"), "open-lists")
        pairs = _centre_pairs(lists, turn, percent) if turn < CENTRES else _other_pairs(lists, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        found = staged(_links(pairs, parts, percent), "pair-links")
        tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))
        if found.limit(1).count():
            links = found if links is None else links.union(found)
            labels = components(links)
    return labels if labels is not None else found.select(F.col("a").alias("node"), F.col("b").alias("comp"))


def grouped(docs: DataFrame, text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """ord, key, doc_id, n_shingles, component_id of every row, and the ord and key of its group's first row."""
    known = staged(members(docs, text, n), "members")
    labels = class_components(docs, known, text, n, percent)
    rows = known.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    firsts = rows.where(F.col("comp").isNotNull()).groupBy("comp").agg(F.min("doc_id").alias("_id"), F.min(F.struct("ord", "key")).alias("_first"))
    rows = rows.join(firsts, "comp", "left")
    first = F.coalesce("_first", F.struct("ord", "key"))
    return rows.select("ord", "key", "doc_id", "n_shingles", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("_id")).alias("component_id"), first["ord"].alias("first_ord"), first["key"].alias("first_key"))


def one_of_each_group(docs: DataFrame, text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """The first row of every group of linked documents, with all columns; rows without n-grams all stay."""
    marks = grouped(docs, text, n, percent)
    stays = marks.where((F.col("ord") == F.col("first_ord")) & (F.col("key") == F.col("first_key")))
    stays = stays.groupBy(F.col("ord").alias("_ord"), F.col("key").alias("_key")).agg((F.max("n_shingles") == 0).alias("_all"))
    rows = docs.select(*docs.columns, order_of().alias("_ord"), text_key(text).alias("_key")).join(stays, ["_ord", "_key"])
    rows = rows.withColumn("_nr", F.row_number().over(Window.partitionBy("_ord", "_key").orderBy("_ord")))
    return rows.where(F.col("_all") | (F.col("_nr") == 1)).select(*docs.columns)
