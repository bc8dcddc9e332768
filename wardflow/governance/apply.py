"""Read a table under a role: masks and row filter sit directly on the scan, below anything the caller adds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.governance.lineage import column_tags, stricter, with_tags
from wardflow.governance.registry import Registry, RowPolicy
from wardflow.governance.roles import DEFAULT_GRANTS, role_closure


def governed(
    df: DataFrame,
    table: str,
    role: str | Iterable[str],
    registry: Registry,
    access: DataFrame | None = None,
    grants: Iterable[tuple[str, str]] = DEFAULT_GRANTS,
) -> DataFrame:
    """The frame as the role may see it.

    Columns carry the tags of all tagged columns they are made from, as the plan tells (see ``lineage``), so a derived
    column is masked without being declared. Where the mask of an inherited tag is for another type, the column is NULL
    for those who would not see the value itself. A harmless one, such as a count, has to be released.
    """
    roles = role_closure(role, grants)
    inherited = {c: tags for c, tags in column_tags(df).items() if any(t not in df.schema[c].metadata.get("tags", {}) for t in tags)}
    df = with_tags(df, inherited) if inherited else df
    policy = registry.row_policies.get(table)
    if policy is not None:
        df = row_policy(df, policy, roles, access)
    masks = {column: mask for column, mask, _ in registry.resolved_masks(df, table, set(inherited))}
    return df.select(
        *[
            masks[f.name].apply(F.col(f.name), roles).alias(f.name, metadata=f.metadata)
            if f.name in masks
            else F.col(f.name)
            for f in df.schema
        ]
    )


def row_policy(df: DataFrame, policy: RowPolicy, roles: frozenset[str], access: DataFrame | None) -> DataFrame:
    """Keep the rows the roles may see: all, those the access table maps to a held role, or none."""
    if roles & policy.full_access:
        return df
    held = roles & policy.mapped
    if not held:
        return df.where(F.lit(False))
    if access is None:
        raise ValueError(f"policy {policy.name} needs the access table")
    allowed = access.where(F.col("role_name").isin(*sorted(held))).select(F.col("department").alias("_allowed"))
    return df.join(allowed, F.col(policy.column) == F.col("_allowed"), "left_semi")


def governed_view(
    name: str,
    df: DataFrame,
    table: str,
    role: str | Iterable[str],
    registry: Registry,
    access: DataFrame | None = None,
) -> DataFrame:
    """A session view that shows a table under its policies."""
    out = governed(df, table, role, registry, access)
    out.createOrReplaceTempView(name)
    return out


def tag_frame(df: DataFrame, registry: Registry, table: str) -> DataFrame:
    """Write the tags of a table's columns into the frame, where they follow selects, joins, views and files."""
    return with_tags(df, registry.column_tags(table))


def propagate_tags(out: DataFrame, lineage: Mapping[str, Sequence[tuple[DataFrame, str]]]) -> DataFrame:
    """Give derived columns the tags of the columns they were computed from (the strictest value wins)."""
    tags: dict[str, dict[str, str]] = {}
    for column, origins in lineage.items():
        for source, name in origins:
            for tag, value in source.schema[name].metadata.get("tags", {}).items():
                known = tags.setdefault(column, {}).get(tag)
                tags[column][tag] = value if known is None else stricter(tag, known, value)
    return with_tags(out, tags)
