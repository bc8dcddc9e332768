"""The graph of derived tables: which node reads what, how it is stored, and how fresh it must be."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.plans import nodes
from wardflow.sources import schemas

DOWNSTREAM = "DOWNSTREAM"
DEFAULT_LAG = "1 minute"


@dataclass(frozen=True)
class Copy:
    """A narrow second copy of a source, stored by another key."""

    name: str
    columns: tuple[str, ...]
    bucket_by: str


@dataclass(frozen=True)
class Source:
    """A raw table that only grows. Its rows are stored in cells: a bucket of one key and the slice they landed in."""

    name: str
    schema: T.StructType
    bucket_by: str
    copies: tuple[Copy, ...] = ()


@dataclass(frozen=True)
class Lookup:
    """An input joined to input ``of`` by ``column`` = ``key``. With ``same_bucket`` both sides are stored by that key.

    Else copies of raw tables can tell where to look: ``at`` is stored by ``key`` and says in which cells of ``name`` a key
    stands; ``by`` is stored by ``column`` and says in which cells of ``of`` a value stands. Both must be made from the
    source whose cells the table keeps. Rows of ``of`` that do not fulfil ``where`` look nothing up.
    """

    name: str
    key: str
    of: str
    column: str
    same_bucket: bool = False
    at: str | None = None
    by: str | None = None
    where: str | None = None


# How finely a node is stored and refreshed.
CELL, BUCKET, WHOLE = "cell", "bucket", "whole"


@dataclass(frozen=True)
class Node:
    """A derived table.

    ``inputs`` go to ``build`` in order. Inputs not named by a lookup share the node's storage key: a change in one of
    their buckets reaches that bucket of the node only. ``grain`` is

    * CELL: one such input; rows stay in the cell they came from, so a refresh costs as much as the new rows,
    * BUCKET: a bucket is computed from all slices of its inputs, for results that combine rows of different times,
    * WHOLE: rebuilt from its inputs, which must be small.

    ``view`` adds the columns that depend on the current day. ``merge`` makes one row of the rows of several cells, grouped
    by the columns it is given; with it, rows of old slices are rolled up for nodes that read whole buckets. ``in_place``
    says that ``build`` handles each row by itself, so the rows of a cell need not be gathered again.
    """

    name: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    grain: str = CELL
    bucket_by: str | None = None
    lookups: tuple[Lookup, ...] = ()
    view: Callable[..., DataFrame] | None = None
    target_lag: str = DEFAULT_LAG
    merge: Callable[..., DataFrame] | None = None
    in_place: bool = False

    @property
    def aligned_inputs(self) -> tuple[str, ...]:
        looked_up = {lk.name for lk in self.lookups}
        return tuple(i for i in self.inputs if i not in looked_up)


class Graph:
    def __init__(self, sources: Iterable[Source], nodes: Iterable[Node]):
        self.sources: dict[str, Source] = {}
        self.copied_from: dict[str, Source] = {}
        for s in sources:
            self.sources[s.name] = s
            for c in s.copies:
                fields = [s.schema[name] for name in c.columns]
                self.sources[c.name] = Source(c.name, T.StructType(fields), c.bucket_by)
                self.copied_from[c.name] = s
        self.nodes = {n.name: n for n in self._ordered({n.name: n for n in nodes})}
        for node in self.nodes.values():
            if node.grain == CELL and [self.grain_of(i) for i in node.aligned_inputs] != [CELL]:
                raise ValueError(f"{node.name} needs exactly one input stored in cells")

            slow = [i for i in node.inputs if i in self.nodes and lag_seconds(self.lag_of(i)) > lag_seconds(self.lag_of(node.name))]
            if slow:
                raise ValueError(f"{node.name} cannot be fresher than its inputs {slow}")

    def grain_of(self, name: str) -> str:
        return CELL if name in self.sources else self.nodes[name].grain

    def _ordered(self, nodes: dict[str, Node]) -> list[Node]:
        """Nodes after their inputs."""
        done: dict[str, Node] = {}
        while len(done) < len(nodes):
            ready = [
                n for n in nodes.values()
                if n.name not in done and all(i in done or i in self.sources for i in n.inputs)
            ]
            if not ready:
                raise ValueError(f"unknown input or cycle among {sorted(set(nodes) - set(done))}")
            done.update((n.name, n) for n in ready)
        return list(done.values())

    def levels(self) -> list[list[Node]]:
        """Nodes in groups: those of a group read only sources and earlier groups."""
        depth: dict[str, int] = {}
        for node in self.nodes.values():
            depth[node.name] = 1 + max((depth.get(i, 0) for i in node.inputs), default=0)
        return [[n for n in self.nodes.values() if depth[n.name] == d] for d in sorted(set(depth.values()))]

    def lag_of(self, name: str) -> str:
        """The lag in force: a DOWNSTREAM node follows its tightest reader."""
        node = self.nodes[name]
        if node.target_lag != DOWNSTREAM:
            return node.target_lag
        readers = [self.lag_of(n.name) for n in self.nodes.values() if name in n.inputs]
        return min(readers, key=lag_seconds, default=DOWNSTREAM)

    def trigger_interval(self) -> str:
        """The tightest lag of any node: the pace at which new rows are looked at."""
        lags = [self.lag_of(n) for n in self.nodes]
        return min((lag for lag in lags if lag != DOWNSTREAM), key=lag_seconds, default=DEFAULT_LAG)

    def listing(self, spark: SparkSession, state: str = "ACTIVE", history: DataFrame | None = None) -> DataFrame:
        """Nodes with lag, state and inputs, by name; with the refresh history, the state of the last refresh."""
        rows = [(n.name, n.target_lag, state, list(n.inputs)) for _, n in sorted(self.nodes.items())]
        out = spark.createDataFrame(rows, "name string, target_lag string, scheduling_state string, inputs array<string>")
        if history is None:
            return out
        last = history.groupBy("name").agg(F.max_by("state", "refresh_start_time").alias("_state"))
        known = F.coalesce("_state", F.lit("NEVER REFRESHED")).alias("scheduling_state")
        return out.join(last, "name", "left").select("name", "target_lag", known, "inputs").orderBy("name")


def clinical_graph(target_lag: str = DEFAULT_LAG, gold_lag: str | None = None, sketches: bool = False) -> Graph:
    """Patients, encounters, labs and providers up to the gold tables, which may follow at a slower pace. With ``sketches``
    there are also estimates of distinct counts, whose refresh reads nothing but merged sketches."""
    sources = [
        Source("raw.patient_dim", schemas.PATIENT, "pat_id"),
        Source("raw.provider_dim", schemas.PROVIDER, "prov_id"),
        Source(
            "raw.encounter_fact",
            schemas.ENCOUNTER,
            "pat_id",
            (Copy("raw.encounter_keys", ("encounter_id", "department", "pat_id"), "encounter_id"),),
        ),
        Source("raw.lab_results", schemas.LAB_RESULT, "pat_id", (Copy("raw.lab_keys", ("encounter_id", "pat_id"), "encounter_id"),)),
    ]
    provider = Lookup("raw.provider_dim", "prov_id", "raw.encounter_fact", "attending_prov_id")
    encounter = Lookup("curated.fact_encounter", "encounter_id", "curated.fact_lab_results", "encounter_id",
                       at="raw.encounter_keys", by="raw.lab_keys", where="abnormal_flag <> 'NORMAL'")
    patient = Lookup("curated.dim_patient", "pat_id", "curated.fact_lab_results", "pat_id", same_bucket=True)
    derived = [
        Node("curated.dim_patient", nodes.dim_patient_stored, ("raw.patient_dim",), view=nodes.dim_patient_view,
             in_place=True),
        Node("curated.dim_provider", nodes.dim_provider, ("raw.provider_dim",), in_place=True),
        Node("curated.fact_encounter", nodes.fact_encounter_stored, ("raw.encounter_fact", "raw.provider_dim"),
             lookups=(provider,), view=nodes.fact_encounter_view),
        Node("curated.fact_lab_results", nodes.fact_lab_results, ("raw.lab_results",), in_place=True),
        Node("curated.encounter_partials", nodes.encounter_partials, ("curated.fact_encounter",),
             target_lag=DOWNSTREAM, merge=nodes.merged_partials),
        Node("gold.patient_encounter_summary", nodes.patient_encounter_summary_merged,
             ("curated.dim_patient", "curated.encounter_partials"), BUCKET, "pat_id",
             view=nodes.patient_encounter_summary_view),
        Node("gold.abnormal_results_summary", nodes.abnormal_results,
             ("curated.fact_lab_results", "curated.fact_encounter", "curated.dim_patient"),
             lookups=(encounter, patient)),
        Node("gold.department_partials", nodes.department_partials, ("curated.encounter_partials",), BUCKET,
             target_lag=DOWNSTREAM),
        Node("gold.department_encounter_counts", nodes.department_encounter_counts, ("raw.encounter_keys",), BUCKET,
             target_lag=DOWNSTREAM),
        Node("gold.department_dashboard", nodes.department_dashboard_stored,
             ("gold.department_partials", "gold.department_encounter_counts"), WHOLE,
             view=nodes.department_dashboard_view),
    ]
    if sketches:
        derived += [
            Node("curated.department_sketches", nodes.department_sketches, ("curated.fact_encounter",),
                 target_lag=DOWNSTREAM, merge=nodes.merged_sketches),
            Node("gold.department_sketch_totals", nodes.merged_sketches, ("curated.department_sketches",), BUCKET,
                 target_lag=DOWNSTREAM),
            Node("gold.department_estimates", nodes.department_estimates_stored, ("gold.department_sketch_totals",), WHOLE,
                 view=nodes.department_estimates_view),
        ]
    lags = {"curated": target_lag, "gold": gold_lag or target_lag}
    return Graph(
        sources,
        [n if n.target_lag == DOWNSTREAM else replace(n, target_lag=lags[n.name.split(".")[0]]) for n in derived],
    )


def lag_seconds(lag: str) -> float:
    if lag == DOWNSTREAM:
        return float("inf")
    number, unit = lag.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
