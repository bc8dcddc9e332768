"""Mix sources to target weights by entropy balancing.

Targets: sources ordered by code point (NULL last) weigh 1, 2, 3, repeating, and share all words; a source whose share
would pass ``CAP`` times its words gets exactly that, and the excess goes to the others by weight.

Rates: of all document rates in [0, CAP] that meet the token constraint of every source, those with the least relative
entropy to taking each document once. They are r = min(CAP, exp(lambda * size / mean size)): one multiplier per source,
which Newton steps find on the convex dual, safeguarded by a bracket. A rate depends on source and size only, so every
step is one aggregate over the histogram of (source, size), which has no hot row however large a source is.

Copies: within a source, the histogram is walked by size and the running sum of wanted copies is rounded; what is left
is mended by one copy of a document of about that size, a few times. The copies of a cell go to its documents by their
rank, counted per salted slice so that no task holds a whole cell.

NULL texts have size 0 and are never taken. Rows that share a doc_id are documents of their own and get copies by
themselves; rows that are equal in all columns are ranked in any order, which gives equal rows. An empty table gives
an empty mix. Extra columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.common import WORD, staged, text_key, whole_text

CAP = 3
WEIGHTS = (1, 2, 3)
STEPS = 40  # Newton steps at most; the bracket halves at the worst
CLOSE = 1e-6  # relative error of a token constraint at which the steps end
MENDS = 3
SALTS = 64
MISSING = "_missing"


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, size in words, and a key of the text; the only pass over the texts."""
    return docs.select("doc_id", F.col("source"), n_words(whole_text(text)).alias("size"), text_key(text).alias("key"))


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: source, source_size, target."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place + 1).cast("int"))
    rows = sources.select("source", "source_size", weight.alias("_w"))
    # Sources reach their cap in the order of size by weight. With the first k at their caps, one unit of weight gets
    # what is left of all words; the first level that no longer passes the next cap is the right one.
    rising = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    cap = F.col("source_size") * float(CAP)
    rows = rows.select(
        "*",
        cap.alias("_cap"),
        (F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum(cap).over(before), F.lit(0.0))).alias("_left"),
        (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))).alias("_weights"),
    )
    level = F.col("_left") / F.col("_weights")
    free = F.min(F.when(F.col("_cap") >= level * F.col("_w"), F.struct(F.col("_cap") / F.col("_w"), level.alias("level")))).over(everything)
    return rows.select("source", "source_size", F.least(F.col("_cap"), F.col("_w") * free["level"]).alias("target"))


def _rate() -> Column:
    tilt = F.col("lam") * F.col("size") / F.col("mean")
    return F.when(F.col("full"), F.lit(float(CAP))).otherwise(F.least(F.lit(float(CAP)), F.exp(F.least(tilt, F.lit(20.0)))))


def multipliers(histogram: DataFrame, goals: DataFrame) -> DataFrame:
    """The dual variable of every source (lam); ``full`` marks sources of which everything is taken CAP times."""
    counts = histogram.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = goals.join(counts, goals.source.eqNullSafe(counts.source)).select(
        goals.source,
        "source_size",
        "target",
        "mean",
        (F.col("target") >= F.col("source_size") * CAP * (1 - 1e-9)).alias("full"),
        F.lit(0.0).alias("lam"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
    )
    for _ in range(STEPS):
        state = staged(_newton(histogram, state), "multipliers")
        worst = state.where(~F.col("full")).agg(F.max("error")).first()[0]
        if worst is None or worst <= CLOSE:
            break
    return state


def _newton(histogram: DataFrame, state: DataFrame) -> DataFrame:
    """One step of all sources: gradient and curvature of the dual from the histogram, then the next multiplier."""
    known = state.select(F.col("source").alias("_s"), "lam", "mean", "full")
    rows = histogram.join(known, F.col("source").eqNullSafe(F.col("_s")))
    tokens = F.col("n") * F.col("size") * _rate()
    slope = F.when(_rate() < CAP, tokens * F.col("size") / F.col("mean")).otherwise(0.0)
    sums = rows.groupBy("source").agg(F.sum(tokens).alias("got"), F.sum(slope).alias("slope"))
    sums = sums.withColumnRenamed("source", "_g")
    at = state.join(sums, F.col("source").eqNullSafe(F.col("_g"))).drop("_g", "error")
    gap = F.col("target") - F.col("got")
    error = F.coalesce(F.abs(gap) / F.when(F.col("target") > 0, F.col("target")), F.lit(0.0))
    low = F.when(gap > 0, F.col("lam")).otherwise(F.col("low"))
    high = F.when(gap <= 0, F.col("lam")).otherwise(F.col("high"))
    at = at.select("source", "source_size", "target", "mean", "full", "lam", low.alias("low"), high.alias("high"), gap.alias("gap"), "slope", error.alias("error"))
    newton = F.col("lam") + F.when(F.col("slope") > 0, F.col("gap") / F.col("slope"))
    middle = F.when(F.col("low").isNull(), F.col("high") - 1 - F.abs("high")).when(F.col("high").isNull(), F.col("low") + 1 + F.abs("low"))
    middle = F.coalesce(middle, (F.col("low") + F.col("high")) / 2)
    inside = (F.col("low").isNull() | (newton > F.col("low"))) & (F.col("high").isNull() | (newton < F.col("high")))
    step = F.when(F.col("error") <= CLOSE / 10, F.col("lam")).when(inside & (F.abs(newton - F.col("lam")) <= 4), newton).otherwise(middle)
    return at.select("source", "source_size", "target", "mean", "full", step.alias("lam"), "low", "high", "error")


def copies(histogram: DataFrame, state: DataFrame) -> DataFrame:
    """How many copies each cell (source, size) gives in all: source, size, n, total, source_size, target."""
    known = state.select(F.col("source").alias("_s"), "source_size", "target", "mean", "full", "lam")
    rows = histogram.join(known, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.withColumn("wanted", F.when(F.col("size") > 0, F.col("n") * _rate()).otherwise(0.0))
    walk = Window.partitionBy("source").orderBy(F.desc("size"))
    upto = F.sum("wanted").over(walk.rowsBetween(Window.unboundedPreceding, 0))
    before = F.coalesce(F.sum("wanted").over(walk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    total = F.floor(upto + 0.5) - F.floor(before + 0.5)
    rows = rows.withColumn("total", F.least(F.when(F.col("size") > 0, F.greatest(total, F.lit(0))).otherwise(0), F.col("n") * CAP))
    rows = rows.select("source", "source_size", "target", "size", "n", "total")
    source = Window.partitionBy("source")
    for _ in range(MENDS):
        rest = F.col("target") - F.sum(F.col("total") * F.col("size")).over(source)
        rows = rows.withColumn("_rest", rest)
        able = F.when(F.col("_rest") > 0, F.col("total") < F.col("n") * CAP).otherwise(F.col("total") > 0)
        off = F.abs(F.abs("_rest") - F.col("size"))
        better = able & (F.col("size") > 0) & (off < F.abs("_rest"))
        chosen = F.min(F.when(better, F.struct(off.alias("off"), F.col("size").alias("size")))).over(source)
        change = F.when(chosen["size"] == F.col("size"), F.signum("_rest").cast("long")).otherwise(0)
        rows = rows.withColumn("total", F.col("total") + F.coalesce(change, F.lit(0))).drop("_rest")
    return rows


def mix(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, key, size, source_size, target, copies, taken for every row of ``docs``."""
    sized = staged(sizes(docs, text), "sizes")
    histogram = staged(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "size-histogram")
    goals = targets(histogram.select("source", (F.col("size") * F.col("n")).alias("size")))
    cells = staged(copies(histogram, multipliers(histogram, goals)), "copies")
    # Rank of a document in its cell: its rank in a salted slice after the documents of earlier slices.
    salted = sized.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "key"), F.lit(SALTS)).cast("int"))
    slice_of = ["source", "size", "_salt"]
    slices = salted.groupBy(*slice_of).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("source", "size").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("_cs")) & (F.col("size") == F.col("_cz"))
    cells = cells.select(F.col("source").alias("_cs"), F.col("size").alias("_cz"), "source_size", "target", "n", "total")
    slices = slices.join(cells, same).select(
        F.col("source").alias("_ss"), F.col("size").alias("_sz"), F.col("_salt").alias("_sk"), "_before", "source_size", "target", "n", "total"
    )
    rank = F.row_number().over(Window.partitionBy(*slice_of).orderBy("doc_id", "key")) - 1
    ranked = salted.withColumn("_rank", rank)
    mine = F.col("source").eqNullSafe(F.col("_ss")) & (F.col("size") == F.col("_sz")) & (F.col("_salt") == F.col("_sk"))
    rows = ranked.join(slices, mine)
    place = F.col("_before") + F.col("_rank")
    # total = base * n + extra: the extra copies lie evenly over the ranks.
    base, extra = F.floor(F.col("total") / F.col("n")), F.col("total") % F.col("n")
    more = F.floor((place + 1) * extra / F.col("n")) - F.floor(place * extra / F.col("n"))
    n_copies = (base + more).cast("int")
    return rows.select(
        "doc_id", "source", "key", "size", "source_size", "target", n_copies.alias("copies"), (n_copies * F.col("size")).cast("long").alias("taken")
    )


def repeated(docs: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken. The columns stay those of ``docs``.

    Rows with the same doc_id and text share the copies that they get together, the first ones one more.
    """
    group = [F.coalesce("doc_id", F.lit(-1)).alias("_id"), F.col("key").alias("_key")]
    taken = mix(docs, text).select(*group, "copies").groupBy("_id", "_key").agg(F.sum("copies").alias("_all"), F.count("*").alias("_rows"))
    marks = [F.coalesce("doc_id", F.lit(-1)).alias("_id"), text_key(text).alias("_key")]
    rows = docs.select(*docs.columns, *marks).withColumn("_nr", F.row_number().over(Window.partitionBy("_id", "_key").orderBy("_id")))
    rows = rows.join(taken, ["_id", "_key"])
    n = F.floor(F.col("_all") / F.col("_rows")) + (F.col("_nr") <= F.col("_all") % F.col("_rows")).cast("int")
    rows = rows.withColumn("_copies", n.cast("int")).where(F.col("_copies") > 0)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)
