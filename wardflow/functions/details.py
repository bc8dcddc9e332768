"""Semi-structured event details held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def detail_of(**fields: Column | str | int | float | bool) -> Column:
    """A detail object built from named values; quotes inside values stay intact."""
    parts = [(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()]
    return F.parse_json(F.to_json(F.struct(*parts)))


def detail_field(detail: Column, key: str, type_: str = "string") -> Column:
    """One typed field of a detail object, NULL where the key is missing or the value does not fit the type."""
    return F.try_variant_get(detail, f"$.{key}", type_)


def has_field(detail: Column, key: str) -> Column:
    """True where the key exists, also when its value is JSON null."""
    return F.try_variant_get(detail, f"$.{key}", "variant").isNotNull()


def misfits(raw: Column) -> Column:
    """How many texts are no JSON at all, as an aggregate; ``try_parse_json`` turns those into NULL."""
    return F.count_if(raw.isNotNull() & F.try_parse_json(raw).isNull())
