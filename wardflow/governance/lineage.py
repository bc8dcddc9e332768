"""From which tagged columns each column of a frame is made, read from its analysed plan.

Spark gives every column an id that stays with it through filters, joins, sorts and views. A new id stands for an
expression; its tags are those of all columns the expression reads. Where the plan does not say what a new column is made
of (a Python function over whole rows, say), it counts as made of all columns the step reads: what is not known to be
harmless stays tagged. Conditions decide which rows there are and pass nothing on.

A column that was released (``release``) is taken to hold nothing of what it was made from, such as a count.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RELEASED = "released"
Tags = dict[str, str]


def stricter(tag: str, a: str, b: str) -> str:
    """Of two values of a tag the more sensitive one; tags without order keep the first."""
    order = ("PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED")
    return max(a, b, key=order.index) if tag == "SENSITIVITY" else a


def united(found: Iterable[Mapping[str, str]]) -> Tags:
    out: Tags = {}
    for tags in found:
        for tag, value in tags.items():
            out[tag] = stricter(tag, out[tag], value) if tag in out else value
    return out


def with_tags(df: DataFrame, tags: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """The frame with tags written to its columns, where they follow it into tables and views."""

    def column(f) -> Column:
        added = tags.get(f.name.lower()) or tags.get(f.name)
        if not added:
            return F.col(f.name)
        meta = {**f.metadata, "tags": {**f.metadata.get("tags", {}), **added}}
        return F.col(f.name).alias(f.name, metadata=meta)

    return df.select(*[column(f) for f in df.schema])


def release(df: DataFrame, *columns: str) -> DataFrame:
    """Declare columns harmless, whatever they are made from."""
    return df.select(*[F.col(c).alias(c, metadata={RELEASED: True}) if c in columns else F.col(c) for c in df.columns])


def column_tags(df: DataFrame) -> dict[str, Tags]:
    """The tags of each column of the frame that has any; of columns with one name the union."""
    plan = _Plan()
    found: dict[str, Tags] = {}
    ids = plan.visit(df._jdf.queryExecution().analyzed())
    for name, i in zip(df.columns, ids, strict=True):
        if plan.tags.get(i):
            found[name] = united([found.get(name, {}), plan.tags[i]])
    return found


def carried(df: DataFrame) -> DataFrame:
    """The frame with the tags its columns inherit, ready to be stored: files know nothing of the plan."""
    tags = column_tags(df)
    return with_tags(df, tags) if tags else df


def _each(scala_seq) -> Iterator:
    return (scala_seq.apply(i) for i in range(scala_seq.size()))


def _kind(node) -> str:
    return node.getClass().getSimpleName()


class _Plan:
    """Tags by column id, collected from the leaves upwards."""

    def __init__(self) -> None:
        self.tags: dict[int, Tags] = {}
        self.ctes: dict[int, list[int]] = {}

    def visit(self, plan) -> list[int]:
        """Work out the tags of all columns below and in a step; the ids of the columns it hands on."""
        below = [self.visit(child) for child in _each(plan.children())]
        kind, output = _kind(plan), list(_each(plan.output()))
        ids = [a.exprId().id() for a in output]
        made = self._made(kind, plan, ids, below)
        for i, attribute in zip(ids, output, strict=True):
            known = {j for columns in below for j in columns}
            found = self.tags.get(i, {}) if i in known and i not in made else made.get(i, {})
            meta = json.loads(attribute.metadata().json())
            self.tags[i] = {} if meta.get(RELEASED) else united([found, meta.get("tags", {})])
        if kind == "CTERelationDef":
            self.ctes[plan.id()] = ids
        return ids

    def _made(self, kind: str, plan, ids: list[int], below: list[list[int]]) -> dict[int, Tags]:
        """The tags of the columns that this step makes or mixes."""
        if kind == "CTERelationRef":
            inner = self.ctes.get(plan.cteId())
            return self._by_place(ids, [inner]) if inner else {i: united(self.tags.values()) for i in ids}
        if kind in ("Union", "Intersect", "Except", "View", "UnionLoop"):
            return self._by_place(ids, below)
        if kind == "Expand":
            projections = [[self._read(e) for e in _each(p)] for p in _each(plan.projections())]
            return {i: united(p[k] for p in projections) for k, i in enumerate(ids)}
        known = {j for columns in below for j in columns}
        new = [i for i in ids if i not in known]
        if not new or not below:
            return {}
        if kind == "Generate":
            return dict.fromkeys(new, self._read(plan.generator()))
        if kind == "LateralJoin":
            self.visit(plan.right().plan())
            return {i: self.tags.get(i, {}) for i in new}
        named = {e.exprId().id(): self._read(e.child()) for e in _each(plan.expressions()) if _kind(e) == "Alias"}
        everything = united(self.tags.get(j, {}) for j in known)
        return {i: named.get(i, everything) for i in new}

    def _by_place(self, ids: list[int], columns: list[list[int]]) -> dict[int, Tags]:
        return {i: united(self.tags.get(c[k], {}) for c in columns) for k, i in enumerate(ids)}

    def _read(self, expression) -> Tags:
        """The tags of all columns that an expression reads, those of the queries inside it included."""
        kind = _kind(expression)
        if kind == "AttributeReference":
            return self.tags.get(expression.exprId().id(), {})
        found = [self._read(child) for child in _each(expression.children())]
        if kind.endswith("Subquery") and kind != "Exists":
            found += [self.tags.get(i, {}) for i in self.visit(expression.plan())]
        if kind == "OuterReference":
            found.append(self._read(expression.e()))
        return united(found)
