"""Find columns that hold personal data, from their names and from the values in them."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.text import matches_whole

# Patterns for whole values, and names that suggest a category.
VALUE_PATTERNS = {
    "SSN": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "PHONE": r"(?:\+?1[-. ]?)?\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}",
    "MRN": r"MRN-[0-9]{6}",
}
# Text every match of a pattern holds; a quick search for it spares most values the pattern.
REQUIRED_TEXT = {"SSN": "-", "EMAIL": "@", "MRN": "MRN-"}
NAME_PATTERNS = {
    "SSN": r"(^|_)ssn($|_)|social_security",
    "EMAIL": r"e_?mail",
    "PHONE": r"phone|mobile|(^|_)fax($|_)",
    "MRN": r"(^|_)mrn($|_)",
    "NAME": r"(first|last|full|patient|maiden)_?name",
    "ADDRESS": r"address|street",
    "DOB": r"birth_?date|date_of_birth|(^|_)dob($|_)",
}
THRESHOLD = 0.8


def classify(
    df: DataFrame,
    patterns: Mapping[str, str] = VALUE_PATTERNS,
    names: Mapping[str, str] = NAME_PATTERNS,
    threshold: float = THRESHOLD,
    anywhere: bool = False,
) -> DataFrame:
    """One row per (column, category) with the share of non-NULL values that match, and a recommendation.

    All columns and patterns are tested in one pass that ends in a single aggregate row. With ``anywhere`` a pattern
    may sit inside a longer text. Columns that are not text are judged by their name only.
    """
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    dates = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]

    def hit(column: str, category: str):
        col, pattern = F.col(column), patterns[category]
        test = col.rlike(pattern) if anywhere else matches_whole(col, pattern)
        quick = REQUIRED_TEXT.get(category) if pattern == VALUE_PATTERNS.get(category) else None
        return test if quick is None else F.contains(col, F.lit(quick)) & test

    aggs = []
    for i, column in enumerate(text):
        aggs.append(F.count(column).alias(f"_n{i}"))
        aggs += [F.count_if(hit(column, category)).alias(f"_m{i}_{category}") for category in patterns]
    entries = []
    categories = list(dict.fromkeys([*patterns, *names]))
    for column in [*text, *dates]:
        for category in categories:
            by_name = bool(category in names and re.search(names[category], column.lower()))
            by_value = column in text and category in patterns
            if column in dates and not by_name:
                continue
            if not by_name and not by_value:
                continue
            i = text.index(column) if by_value else None
            count, matched = (f"_n{i}", f"`_m{i}_{category}`") if by_value else ("0L", "0L")
            rate = f"coalesce(try_divide({matched}, {count}), 0D)"
            known = str(by_name).lower()
            entries.append(
                f"named_struct('column_name', {_quoted(column)}, 'category', {_quoted(category)}, "
                f"'n_values', {count}, 'n_matches', {matched}, 'match_rate', {rate}, "
                f"'name_match', {known}, 'recommended', {rate} >= {float(threshold)}D OR {known})"
            )
    if not entries:
        columns = (
            "column_name string, category string, n_values bigint, n_matches bigint, match_rate double, "
            "name_match boolean, recommended boolean"
        )
        return df.sparkSession.createDataFrame([], columns)
    # The rows are spelled out as text: there are many, and each Column call is a round trip to the JVM.
    counted = df.agg(*aggs) if aggs else df.sparkSession.range(1)
    return counted.select(F.expr(f"inline(array({', '.join(entries)}))"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def recommended_tags(classified: DataFrame, table: str, tag: str = "PII_TYPE", database: str = "LAB") -> DataFrame:
    """Tag references for every recommended column; of several categories the one with the best match wins."""
    schema, _, name = table.rpartition(".")
    best = classified.where("recommended").groupBy("column_name").agg(
        F.max_by("category", F.struct("match_rate", "name_match", "category")).alias("tag_value")
    )
    return best.select(
        F.lit(tag).alias("tag_name"),
        "tag_value",
        F.lit("COLUMN").alias("domain"),
        F.lit(database).alias("object_database"),
        F.lit(schema).alias("object_schema"),
        F.lit(name).alias("object_name"),
        "column_name",
    )
