"""Tags, masks and row policies and the objects they are bound to.

The registry holds governance declarations made by people (a few per column), never data.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.governance.masks import MASK_DOB, MASK_PII_STRING, MASK_SSN, MaskPolicy, closed
from wardflow.sources.schemas import TAG_REFERENCE

DOMAINS = ("DATABASE", "WAREHOUSE", "SCHEMA", "TABLE", "COLUMN")


@dataclass(frozen=True)
class RowPolicy:
    """Roles that see every row, and roles that see the rows the access table maps to them."""

    name: str
    column: str
    full_access: frozenset[str]
    mapped: frozenset[str]
    comment: str = ""


@dataclass(frozen=True)
class TagDefinition:
    name: str
    allowed: tuple[str, ...] | None = None
    comment: str = ""


@dataclass(frozen=True)
class ObjectName:
    """A tagged object; the deepest part given decides its domain."""

    database: str | None = None
    schema: str | None = None
    table: str | None = None
    column: str | None = None
    warehouse: str | None = None

    @property
    def domain(self) -> str:
        if self.warehouse:
            return "WAREHOUSE"
        for part, name in ((self.column, "COLUMN"), (self.table, "TABLE"), (self.schema, "SCHEMA")):
            if part:
                return name
        if self.database:
            return "DATABASE"
        raise ValueError("tags go on databases, warehouses, schemas, tables and columns")


@dataclass
class Registry:
    database: str = "LAB"
    tags: dict[str, TagDefinition] = field(default_factory=dict)
    bindings: dict[tuple[ObjectName, str], str] = field(default_factory=dict)
    column_masks: dict[tuple[str, str], MaskPolicy] = field(default_factory=dict)
    tag_masks: dict[str, MaskPolicy] = field(default_factory=dict)
    row_policies: dict[str, RowPolicy] = field(default_factory=dict)

    # --- tags ---

    def define_tag(self, name: str, allowed: Sequence[str] | None = None, comment: str = "") -> None:
        self.tags[name] = TagDefinition(name, None if allowed is None else tuple(allowed), comment)

    def set_tag(
        self,
        tag: str,
        value: str,
        table: str | None = None,
        column: str | None = None,
        schema: str | None = None,
        database: str | None = None,
        warehouse: str | None = None,
    ) -> None:
        """Tag one object. ``table`` may carry its schema, as in ``raw.patient_dim``."""
        if tag not in self.tags:
            raise ValueError(f"tag {tag} is not defined")
        allowed = self.tags[tag].allowed
        if allowed is not None and value not in allowed:
            raise ValueError(f"{value!r} is not an allowed value of tag {tag}")
        self.bindings[self._object(table, column, schema, database, warehouse), tag] = value

    def unset_tag(self, tag: str, **where: str) -> None:
        names = {"table": None, "column": None, "schema": None, "database": None, "warehouse": None, **where}
        self.bindings.pop((self._object(**names), tag), None)

    def _object(self, table, column, schema, database, warehouse) -> ObjectName:
        if warehouse:
            return ObjectName(warehouse=warehouse)
        if table and "." in table:
            schema, table = table.split(".", 1)
        return ObjectName(database or self.database, schema, table, column and column.lower())

    def column_tags(self, table: str) -> dict[str, dict[str, str]]:
        """Tags by column of one table."""
        schema, _, name = table.rpartition(".")
        out: dict[str, dict[str, str]] = {}
        for (obj, tag), value in self.bindings.items():
            if obj.column and obj.table == name and (obj.schema or "") == schema:
                out.setdefault(obj.column, {})[tag] = value
        return out

    def tag_definitions(self, spark: SparkSession) -> DataFrame:
        """All tags with their allowed values, NULL where any value goes."""
        tags = sorted(self.tags.values(), key=lambda t: t.name)
        rows = [(t.name, None if t.allowed is None else list(t.allowed), t.comment) for t in tags]
        return spark.createDataFrame(rows, "tag_name string, allowed_values array<string>, comment string")

    def tag_references(self, spark: SparkSession) -> DataFrame:
        """Every tagged object as a row."""
        rows = [
            (tag, value, o.domain, o.database, o.schema, o.table or o.warehouse, o.column)
            for (o, tag), value in self.bindings.items()
        ]
        return spark.createDataFrame(rows, TAG_REFERENCE)

    # --- policies ---

    def set_mask(self, table: str, column: str, policy: MaskPolicy) -> None:
        self.column_masks[table, column.lower()] = policy

    def set_tag_mask(self, tag: str, policy: MaskPolicy) -> None:
        self.tag_masks[tag] = policy

    def set_row_policy(self, table: str, policy: RowPolicy) -> None:
        self.row_policies[table] = policy

    def mask_for(self, table: str, column: str, data_type: str, tags: dict[str, str], inherited: bool = False) -> MaskPolicy | None:
        """The mask of one column: its own one first (of another type it is an error, not a leak), else the one of a tag it
        carries, if the types agree. A column that inherited its tags is closed where they don't."""
        own = self.column_masks.get((table, column.lower()))
        if own is not None:
            if own.data_type != data_type:
                raise ValueError(f"mask {own.name} is for {own.data_type}, but {table}.{column} is {data_type}")
            return own
        for tag in tags:
            policy = self.tag_masks.get(tag)
            if policy is not None and policy.data_type == data_type:
                return policy
        bound = [self.tag_masks[t] for t in tags if t in self.tag_masks]
        return closed(bound[0], data_type) if inherited and bound else None

    def policies(self, spark: SparkSession) -> DataFrame:
        """All policies in use."""
        masks = {p.name: p for p in [*self.column_masks.values(), *self.tag_masks.values()]}
        rows = [(p.name, "MASKING_POLICY", p.comment) for p in masks.values()]
        rows += [(p.name, "ROW_ACCESS_POLICY", p.comment) for p in set(self.row_policies.values())]
        return spark.createDataFrame(sorted(rows), "policy_name string, policy_kind string, comment string")

    def policy_references(self, df: DataFrame, table: str) -> DataFrame:
        """The policies that protect a table: by column, by tag or by row."""
        rows = []
        for column, policy, tag in self.resolved_masks(df, table):
            rows.append((policy.name, "MASKING_POLICY", table, column, tag))
        row_policy = self.row_policies.get(table)
        if row_policy is not None:
            rows.append((row_policy.name, "ROW_ACCESS_POLICY", table, row_policy.column, None))
        return df.sparkSession.createDataFrame(
            rows,
            "policy_name string, policy_kind string, ref_entity_name string, ref_column_name string, tag_name string",
        )

    def resolved_masks(self, df: DataFrame, table: str, inherited: Collection[str] = ()) -> list[tuple[str, MaskPolicy, str | None]]:
        """(column, mask, tag it came by) for every protected column of a frame; ``inherited`` names the columns whose tags
        come from what they are made of."""
        bound = self.column_tags(table)
        out = []
        for f in df.schema:
            tags = {**f.metadata.get("tags", {}), **bound.get(f.name.lower(), {})}
            policy = self.mask_for(table, f.name, f.dataType.simpleString(), tags, f.name in inherited)
            if policy is not None:
                own = (table, f.name.lower()) in self.column_masks
                out.append((f.name, policy, None if own else next((t for t in tags if self.tag_masks.get(t) is policy), next(iter(tags), None))))
        return out


# --- searches over tag references --------------------------------------------------------------------------------------


def find_tagged(
    refs: DataFrame, tag: str, value: str | None = None, domain: str | None = None, database: str | None = None
) -> DataFrame:
    """Objects carrying a tag, optionally with one value, of one domain or in one database."""
    cond = F.col("tag_name") == tag
    for column, wanted in (("tag_value", value), ("domain", domain), ("object_database", database)):
        if wanted is not None:
            cond = cond & (F.col(column) == wanted)
    return (
        refs.where(cond)
        .select("object_database", "object_schema", "object_name", "column_name", "tag_value")
        .orderBy(*[F.col(c).asc_nulls_last() for c in ("object_schema", "object_name", "column_name")])
    )


def map_labels(refs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Tag references with the label an outside catalog uses for (tag, value); NULL where none is mapped."""
    return refs.join(mapping, ["tag_name", "tag_value"], "left")


def unmapped_labels(refs: DataFrame, mapping: DataFrame) -> DataFrame:
    """References whose tag value has no outside label."""
    return refs.join(mapping, ["tag_name", "tag_value"], "left_anti")


# --- the standard set of declarations -----------------------------------------------------------------------------------

# Tags with their allowed values.
PII_TYPE = ("SSN", "NAME", "EMAIL", "PHONE", "ADDRESS", "DOB", "MRN")
SENSITIVITY = ("PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED")
DATA_DOMAIN = ("CLINICAL", "FINANCIAL", "OPERATIONAL", "RESEARCH")
# Kind of personal data by column of the patient table.
PATIENT_PII = {
    "ssn": "SSN",
    "pat_first_name": "NAME",
    "pat_last_name": "NAME",
    "email": "EMAIL",
    "phone": "PHONE",
    "address_line_1": "ADDRESS",
    "birth_date": "DOB",
    "pat_mrn": "MRN",
}


def clinical_registry(patient_table: str = "raw.patient_dim", encounter_table: str = "raw.encounter_fact") -> Registry:
    """Tags, masks and the department filter for the clinical base tables."""
    reg = Registry()
    reg.define_tag("PII_TYPE", PII_TYPE, "kind of personal data in a column")
    reg.define_tag("SENSITIVITY", SENSITIVITY, "sensitivity level")
    reg.define_tag("DATA_DOMAIN", DATA_DOMAIN, "business domain that owns the data")
    reg.define_tag("COST_CENTER", None, "who pays for the compute")
    reg.set_tag("DATA_DOMAIN", "CLINICAL", database=reg.database)
    reg.set_tag("COST_CENTER", "Analytics", warehouse="COMPUTE")
    for column, kind in PATIENT_PII.items():
        reg.set_tag("PII_TYPE", kind, table=patient_table, column=column)
    reg.set_tag("SENSITIVITY", "RESTRICTED", table=patient_table, column="ssn")
    reg.set_tag("SENSITIVITY", "CONFIDENTIAL", table=patient_table)
    reg.set_tag_mask("PII_TYPE", MASK_PII_STRING)
    reg.set_mask(patient_table, "ssn", MASK_SSN)
    reg.set_mask(patient_table, "birth_date", MASK_DOB)
    reg.set_row_policy(encounter_table, DEPARTMENT_ROW_FILTER)
    return reg


# Names of the policies and who sees what.
DEPARTMENT_ROW_FILTER = RowPolicy(
    "DEPARTMENT_ROW_FILTER",
    "department",
    full_access=frozenset({"ADMIN", "ANALYST"}),
    mapped=frozenset({"CLINICIAN"}),
    comment="Clinicians are limited to departments in the access table; the two other roles have no limit",
)
