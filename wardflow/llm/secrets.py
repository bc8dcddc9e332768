"""Secret scans with multipart credential linking.

Base kinds are regular expressions over the whole text. Their positions follow from splitting the text at the matches:
a match begins where all pieces and matches before it end. Linking adds parts that are no evidence by themselves:
identifiers (user, client or access key names with a value), short or unnamed secrets, and endpoints (URLs, hosts). A
part opens a scope of ``SCOPE`` code points around itself. Scopes of one role in one text are merged into disjoint
intervals, so an interval join meets each candidate with few of them, and a weak candidate is reported only if it lies
in a scope of a role that completes it: a secret needs an identifier or an endpoint, the others need a secret. Base
spans stay as they are and serve as strong parts: assigned values and hex runs as secrets, access keys as identifiers.

Scopes of a text that is cut into cells of SCOPE code points are joined by cell, so a text with very many parts does
not meet in one task.

NULL texts count as empty and have no spans. Rows with the same doc_id and text have the same result. Only doc_id and
the text are read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.common import staged, text_key, whole_text

SCOPE = 300
BLOCK = 128  # matches per block when positions are summed

# The base kinds, their patterns and least lengths.
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a run of 18 characters or more, whole
HEX = r"[0-9a-f]{16,}"  # a run of 16 characters or more, whole

# Weak candidates by role.
IDENTIFIER = r"""(?i)\b(?:access[_ -]?key(?:[_ -]?id)?|client[_ -]?id|user(?:_?name)?|login|account)["']?\x20{0,4}[:=]\x20{0,4}["']?([A-Za-z0-9_.@-]{3,})"""
SECRET = r"""(?i)\b(?:pwd|pass|passwd|password|secret|token|api_?key|private[_ -]?key|access[_ -]?secret)["']?\x20{0,4}[:=]\x20{0,4}["']?([A-Za-z0-9+/_.=-]{6,})"""
ENDPOINT = r"""(?i)\b(?:https?|s3|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+"""

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
ROLE = {"assign": "secret", "hex": "secret", "access": "identifier", "identifier": "identifier", "secret": "secret", "endpoint": "endpoint"}
SPAN = "array<struct<start:bigint,end:bigint>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once; inside a lambda Spark works expressions out per element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sums_before(values: Column) -> Column:
    """For each value the sum of all earlier ones; sums of blocks keep the work for very many values small."""
    zero, block = F.lit(0).cast("long"), F.lit(BLOCK)

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, lambda acc, x: acc + x)

    def heads(v: Column) -> Column:
        ids = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / block).cast("int"))
        blocks = F.transform(ids, lambda b: total(F.slice(v, b * block + 1, block)))
        return F.aggregate(blocks, F.array(zero), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def spread(v: Column, h: Column) -> Column:
        return F.transform(v, lambda _, i: F.element_at(h, F.floor(i / block).cast("int") + 1) + total(F.slice(v, i - i % block + 1, i % block)))

    return _let(values, lambda v: _let(heads(v), lambda h: spread(v, h)))


def _placed(gaps: Column, sizes: Column) -> Column:
    """The spans of matches, from the lengths of the pieces between them and their own."""
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(sizes)).alias("gap"), sizes.alias("size"))

    def spans(p: Column) -> Column:
        begins = _sums_before(F.transform(p, lambda x: x["gap"] + x["size"]))
        return F.transform(
            F.arrays_zip(begins.alias("at"), p.alias("x")),
            lambda y: F.struct((y["at"] + y["x"]["gap"]).alias("start"), (y["at"] + y["x"]["gap"] + y["x"]["size"]).alias("end")),
        )

    return _let(pairs, spans)


def _spans(text: Column, pattern: str) -> Column:
    """Start and end (code points, end exclusive) of the leftmost matches that do not overlap."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x).cast("long"))
    found = _let(gaps, lambda g: _let(sizes, lambda z: _placed(g, z)))
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(F.array().cast(SPAN))


def _long_enough(text: Column, spans: Column, pattern: str, least: int) -> Column:
    """Spans whose first group has ``least`` characters or more; the matches are those of the spans, in order."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    kept = F.filter(F.arrays_zip(spans.alias("s"), values.alias("v")), lambda x: F.length(x["v"]) >= least)
    return F.when(F.size(spans) > 0, F.transform(kept, lambda x: x["s"])).otherwise(spans)


def parts(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, key and one array of spans per kind, for every row; the only pass over the texts."""
    t = F.col("_text")
    rows = docs.select("doc_id", text_key(text).alias("key"), whole_text(text).alias("_text"))
    rows = rows.withColumn("_assign", _spans(t, ASSIGN)).withColumn("_identifier", _spans(t, IDENTIFIER)).withColumn("_secret", _spans(t, SECRET))
    return rows.select(
        "doc_id",
        "key",
        _long_enough(t, F.col("_assign"), ASSIGN, ASSIGN_LEAST).alias("assign"),
        _spans(t, ACCESS).alias("access"),
        _spans(t, HEX).alias("hex"),
        F.col("_identifier").alias("identifier"),
        F.col("_secret").alias("secret"),
        _spans(t, ENDPOINT).alias("endpoint"),
    )


def _listed(found: DataFrame) -> DataFrame:
    """One row per part of every different (doc_id, key) that has any."""
    def tag(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), F.lit(ROLE[kind]).alias("role"), s["start"].alias("start"), s["end"].alias("end")))

    tagged = F.concat(*[tag(k) for k in KINDS])
    rows = found.withColumn("part", tagged).where(F.size("part") > 0).dropDuplicates(["doc_id", "key"])
    return rows.select(F.coalesce("doc_id", F.lit(-1)).alias("_id"), F.col("doc_id").isNull().alias("_none"), "key", F.explode("part").alias("p")).select("_id", "_none", "key", "p.*")


def _scopes(listed: DataFrame, scope: int) -> DataFrame:
    """Disjoint intervals per text and role: the merged surroundings of its parts, one row per cell they reach."""
    group = Window.partitionBy("_id", "_none", "key", "role")
    rows = listed.select("_id", "_none", "key", "role", (F.col("start") - scope).alias("a"), (F.col("end") + scope).alias("b")).distinct()
    ordered = group.orderBy("a", "b")
    reached = F.max("b").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_new", (reached.isNull() | (F.col("a") > reached)).cast("int"))
    rows = rows.withColumn("_island", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    merged = rows.groupBy("_id", "_none", "key", "role", "_island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    cells = F.sequence(F.floor(F.col("a") / scope), F.floor(F.col("b") / scope))
    return merged.select("_id", "_none", "key", F.col("role").alias("by"), "a", "b", F.explode(cells).alias("cell"))


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak candidates that a complementary part is near: doc_id, key, kind, start, end."""
    listed = staged(_listed(found), "credential-parts")
    weak = listed.where(F.col("kind").isin("identifier", "secret", "endpoint"))
    weak = weak.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))))
    scopes = _scopes(listed, scope)
    completes = F.when(F.col("role") == "secret", F.col("by").isin("identifier", "endpoint")).otherwise(F.col("by") == "secret")
    near = weak.join(scopes, ["_id", "_none", "key", "cell"]).where(completes & (F.col("a") < F.col("end")) & (F.col("start") < F.col("b")))
    return near.select("_id", "_none", "key", "kind", "start", "end").distinct()


def scan(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """doc_id, key and the arrays ``base`` and ``spans`` of (start, place of the kind, kind, end), in order."""
    found = staged(parts(docs, text), "credential-spans")
    place = {k: i for i, k in enumerate(KINDS)}

    def placed(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(place[kind]).alias("place"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    base = F.array_sort(F.concat(*[placed(k) for k in KINDS[:3]]))
    order = F.create_map(*[F.lit(x) for k in KINDS for x in (k, place[k])])
    weak = linked(found, scope).withColumn("span", F.struct("start", order[F.col("kind")].alias("place"), "kind", "end"))
    # The spans of one text meet in one row, as they do in its text.
    weak = weak.groupBy("_id", "_none", "key").agg(F.collect_list("span").alias("more"))
    rows = found.select("doc_id", "key", base.alias("base"), F.coalesce("doc_id", F.lit(-1)).alias("_id"), F.col("doc_id").isNull().alias("_none"))
    rows = rows.join(weak, ["_id", "_none", "key"], "left")
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>"))))
    return rows.select("doc_id", "key", "base", spans.alias("spans"))


def _written(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(scanned: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_written("base"), 256).alias("base_sha256"),
        _written("spans").alias("spans"),
    )


def redacted(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """The rows of ``docs`` with every found span replaced by ``[kind]``; the columns stay those of ``docs``.

    Where spans overlap, the first one names the replacement and it reaches to the last end.
    """
    scanned = scan(docs, text, scope).where(F.size("spans") > 0).dropDuplicates(["doc_id", "key"])
    scanned = scanned.select(F.coalesce("doc_id", F.lit(-1)).alias("_id"), F.col("doc_id").isNull().alias("_none"), F.col("key").alias("_key"), F.col("spans").alias("_spans"))
    rows = docs.select(*docs.columns, F.coalesce("doc_id", F.lit(-1)).alias("_id"), F.col("doc_id").isNull().alias("_none"), text_key(text).alias("_key"))
    rows = rows.join(scanned, ["_id", "_none", "_key"], "left")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        # substring counts from 1; spans inside what was replaced already add nothing.
        before = F.col(text).substr((acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        mark = F.when(s["start"] >= acc["at"], F.concat(before, F.lit("["), s["kind"], F.lit("]"))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], mark).alias("out"))

    clean = F.aggregate("_spans", start, step, lambda acc: F.concat(acc["out"], F.col(text).substr((acc["at"] + 1).cast("int"), F.length(text))))
    new = F.when(F.col("_spans").isNotNull() & F.col(text).isNotNull(), clean).otherwise(F.col(text))
    return rows.select(*[new.alias(c) if c == text else F.col(c) for c in docs.columns])
