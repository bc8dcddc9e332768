"""Row rules, schema drift and format clean-up for incoming batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.text import matches_whole
from wardflow.sources.schemas import VENDOR_LAB


@dataclass(frozen=True)
class Rule:
    """What one column must satisfy. A row gets at most one reason per rule."""

    column: str
    required: bool = False
    pattern: str | None = None
    allowed: tuple[str, ...] | None = None

    def reason(self) -> Column:
        """The text of the complaint (the wording is a fixed value), NULL for a good value."""
        col, label = F.col(self.column), self.column.upper()
        checks: list[tuple[Column, Column]] = []
        if self.required:
            checks.append((col.isNull(), F.lit(f"{label} is NULL")))
        if self.pattern is not None:
            bad = ~matches_whole(col, self.pattern)
            checks.append((bad, F.concat(F.lit(f"{label} format invalid: "), col)))
        if self.allowed is not None:
            bad = col.isNotNull() & ~col.isin(*self.allowed)
            checks.append((bad, F.concat(F.lit(f"{label} invalid value: "), col)))
        out = F.lit(None).cast("string")
        for test, text in reversed(checks):
            out = F.when(test, text).otherwise(out)
        return out

    def reason_sql(self, param: str) -> str:
        """The same complaint as SQL text over a function parameter."""
        label, whens = self.column.upper(), []
        if self.required:
            whens.append(f"WHEN {param} IS NULL THEN '{label} is NULL'")
        if self.pattern is not None:
            whens.append(f"WHEN NOT {param} RLIKE r'\\A(?:{self.pattern})\\z' THEN '{label} format invalid: ' || {param}")
        if self.allowed is not None:
            values = ", ".join(f"'{v}'" for v in self.allowed)
            whens.append(f"WHEN {param} NOT IN ({values}) THEN '{label} invalid value: ' || {param}")
        return f"CASE {' '.join(whens)} END"


# The rules of the vendor lab feed, in the order their reasons are listed.
VENDOR_LAB_RULES = (
    Rule("vendor_id", required=True, pattern="VL-[0-9]{6}"),
    Rule("pat_mrn", required=True, pattern="MRN-[0-9]{6}"),
    Rule("test_code", required=True),
    Rule("result_date", required=True),
    Rule("abnormal_yn", allowed=("Y", "N")),
)


# Values of a row that do not fit the declared types, by column.
REJECTED = "rejected_values"


def rejection_reasons(rules: Sequence[Rule] = VENDOR_LAB_RULES) -> Column:
    return F.array_compact(F.array(*[r.reason() for r in rules]))


def with_validation(df: DataFrame, rules: Sequence[Rule] = VENDOR_LAB_RULES) -> DataFrame:
    """Every row with its verdict and the list of all reasons against it.

    A value that ``align`` could not fit to its type is a reason of its own, also in columns without a rule.
    """
    reasons = rejection_reasons(rules)
    if REJECTED in df.columns:
        others = F.map_filter(REJECTED, lambda k, _: ~k.isin([r.column for r in rules]))
        checked = F.array(*[F.when(F.col(REJECTED)[r.column].isNotNull(), _misfit(F.lit(r.column), F.col(REJECTED)[r.column])).otherwise(r.reason()) for r in rules])
        unchecked = F.transform(F.map_entries(others), lambda e: _misfit(e["key"], e["value"]))
        reasons = F.array_compact(F.concat(checked, F.coalesce(unchecked, F.array().cast("array<string>"))))
    return df.withColumn("rejection_reasons", reasons).withColumn("is_valid", F.size("rejection_reasons") == 0)


def _misfit(column: Column, value: Column) -> Column:
    return F.concat(F.upper(column), F.lit(" format invalid: "), value)


def register_sql_function(
    spark: SparkSession, name: str = "validate_vendor_lab_row", rules: Sequence[Rule] = VENDOR_LAB_RULES,
    schema: T.StructType = VENDOR_LAB,
) -> None:
    """Offer the rules to SQL text as a table function of the checked columns, for use with LATERAL.

    It returns one row (is_valid, rejection_reasons) and is planned inline, like the column form.
    """
    params = ", ".join(f"p_{r.column} {schema[r.column].dataType.simpleString()}" for r in rules)
    reasons = ", ".join(r.reason_sql(f"p_{r.column}") for r in rules)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) "
        "RETURNS TABLE (is_valid BOOLEAN, rejection_reasons ARRAY<STRING>) "
        f"RETURN SELECT size(reasons) = 0, reasons FROM (SELECT array_compact(array({reasons})) AS reasons)"
    )


def reason_counts(df: DataFrame, reasons: str = "rejection_reasons") -> DataFrame:
    """How often each kind of reason occurs; the offending value is cut off so that kinds fall together."""
    kind = F.split_part(F.col("reason"), F.lit(":"), F.lit(1))
    each = df.select(F.explode(reasons).alias("reason"))
    return each.groupBy(kind.alias("reason")).agg(F.count("*").alias("n_rows"))


def quarantine_report(df: DataFrame) -> DataFrame:
    """Rejected rows with their reasons as JSON text."""
    return df.select("vendor_id", "pat_mrn", "test_code", "batch_id", F.to_json("rejection_reasons").alias("reasons"))


@dataclass(frozen=True)
class Drift:
    """How an incoming schema differs from the expected one."""

    incoming: int
    expected: int
    differences: tuple[tuple[str, str, str | None, str | None], ...]

    @property
    def drifted(self) -> bool:
        """True when more columns come in than expected."""
        return self.incoming > self.expected


def detect_drift(df: DataFrame, expected: T.StructType) -> Drift:
    """Compare schemas: column counts, and columns added, missing or of another type. Reads no data."""
    have = {f.name.lower(): f.dataType.simpleString() for f in df.schema}
    want = {f.name.lower(): f.dataType.simpleString() for f in expected}
    found: list[tuple[str, str, str | None, str | None]] = []
    for name in [*want, *[n for n in have if n not in want]]:
        if name not in have:
            found.append(("missing", name, want[name], None))
        elif name not in want:
            found.append(("extra", name, None, have[name]))
        elif have[name] != want[name]:
            found.append(("retyped", name, want[name], have[name]))
    return Drift(len(have), len(want), tuple(found))


def drift_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per difference, with the number of rows that carry a value in the column (one pass over the data)."""
    drift = detect_drift(df, expected)
    present = [name for kind, name, _, _ in drift.differences if kind != "missing"]
    counted = df.agg(F.count("*").alias("_rows"), *[F.count(n).alias(n) for n in present])
    entries = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.lit(name).alias("column_name"),
            F.lit(want).cast("string").alias("expected_type"),
            F.lit(have).cast("string").alias("incoming_type"),
            (F.lit(0) if kind == "missing" else F.col(name)).cast("bigint").alias("rows_with_value"),
        )
        for kind, name, want, have in drift.differences
    ]
    if not entries:
        columns = "kind string, column_name string, expected_type string, incoming_type string, rows_with_value bigint"
        return df.sparkSession.createDataFrame([], columns)
    return counted.select(F.inline(F.array(*entries)))


def align(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The expected columns: extra ones are dropped, missing ones are NULL, values that do not fit become NULL.

    What did not fit is kept as text in the map column REJECTED (NULL where everything fits).
    """
    have = {f.name.lower(): f for f in df.schema}
    columns, lost = [], []
    for f in expected:
        if f.name not in have:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        raw = F.col(have[f.name].name)
        value = raw.try_cast(f.dataType)
        columns.append(value.alias(f.name))
        if have[f.name].dataType != f.dataType:
            lost.append(F.when(raw.isNotNull() & value.isNull(), F.struct(F.lit(f.name).alias("key"), raw.cast("string").alias("value"))))
    rejected = F.array_compact(F.array(*lost)) if lost else None
    kept = F.when(F.size(rejected) > 0, F.map_from_entries(rejected)) if lost else F.lit(None)
    return df.select(*columns, kept.cast("map<string,string>").alias(REJECTED))


def normalize_formats(df: DataFrame, spec: Mapping[str, Sequence[str | tuple[str, ...]]]) -> DataFrame:
    """Clean columns step by step before validation.

    A step is "trim", "upper", "lower", "empty_to_null", ("replace", pattern, text) or ("date", format, ...), where the
    first format that parses wins.
    """
    return df.withColumns({name: _normalized(F.col(name), steps) for name, steps in spec.items()})


def _normalized(col: Column, steps: Sequence[str | tuple[str, ...]]) -> Column:
    simple = {"trim": F.trim, "upper": F.upper, "lower": F.lower, "empty_to_null": lambda c: F.nullif(c, F.lit(""))}
    for step in steps:
        if isinstance(step, str):
            col = simple[step](col)
        elif step[0] == "replace":
            col = F.regexp_replace(col, step[1], step[2])
        elif step[0] == "date":
            col = F.coalesce(*[F.try_to_timestamp(col, F.lit(fmt)).cast("date") for fmt in step[1:]])
        else:
            raise ValueError(f"unknown step {step!r}")
    return col
