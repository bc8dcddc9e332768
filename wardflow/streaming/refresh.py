"""Keep a graph of derived tables fresh as raw tables grow.

Raw rows are landed in cells: a bucket of their key and a slice, usually the day they arrived. One streaming query
watches the raw folders and reports which cells got rows. Each micro-batch walks the graph: a node recomputes only what
its changed inputs reach, with the same functions the batch path uses, and replaces it. Row by row nodes redo the
touched cells; results that combine rows of all times redo the touched buckets from rows reduced per cell before. A
replayed micro-batch computes the same cells again, so nothing is ever counted twice.

Such reduced rows are rolled up: every ``FAN`` slices, in the order they first came, make a group of level 1, every FAN
groups one of the next level. A bucket is then merged from a few groups of each level and the slices since the last full
group, however many slices there are. A late row redoes the groups above its slice, one per level, for its bucket.

Tables with different target lags have a streaming query per lag, each with a checkpoint of its own. What a slower table
has not seen yet is thus what its own query has not read; there is no list of it anywhere else. A query refreshes the
tables of its lag and all they are made from, since a faster query may not have come to the same rows yet.

Where one table looks another one up by key, a narrow copy of the raw rows stored by that key tells in which cells a key
stands, so that only those are read. Cells are joined with the folders they name, at any number.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardflow.functions.dates import second_boundaries
from wardflow.plans.graph import BUCKET, CELL, WHOLE, Graph, Lookup, Node, lag_seconds
from wardflow.plans.nodes import STORAGE
from wardflow.sources import files
from wardflow.sources.schemas import REFRESH_HISTORY
from wardflow.sources.tables import latest
from wardflow.streaming.journal import TRIGGERS, Journal, TriggerWatch, micros, shown

LIVE = "_live"
CELLS = "of string, bucket int, slice string"
CHANGED = "bucket int, slice string, key string, source string"
ONLY = "only "
FAN = 8  # slices in a group of level 1, groups in one of the next level
LEVEL_FIELDS = [T.StructField("bucket", T.IntegerType()), T.StructField("level", T.IntegerType()), T.StructField("grp", T.IntegerType())]
HISTORY_FILE = "name string, state string, state_message string, batch_id bigint, touched_cells bigint, start_us bigint, end_us bigint"
STORAGE_FIELDS = [T.StructField("bucket", T.IntegerType()), T.StructField("slice", T.StringType())]


@dataclass(frozen=True)
class Running:
    """The streaming queries of a store, one per target lag, the tightest first."""

    queries: dict[str, StreamingQuery]

    def processAllAvailable(self) -> None:
        """Wait until the query of the tightest lag has seen all rows; slower ones keep to their lag."""
        next(iter(self.queries.values())).processAllAvailable()

    def stop(self) -> None:
        for query in self.queries.values():
            query.stop()

    def awaitTermination(self) -> None:
        for query in self.queries.values():
            query.awaitTermination()


class GraphRefresher:
    """Storage and refresh of one graph below ``root`` (a folder all executors share).

    ``n_buckets`` is fixed for the life of the store: choose it so that a bucket of the largest table holds some 100 MB
    to a few GB per slice. ``after_node`` is called with each refreshed node, for example to publish a gold table.
    """

    def __init__(
        self,
        spark: SparkSession,
        graph: Graph,
        root: str,
        n_buckets: int = 16,
        after_node: Callable[[GraphRefresher, str], None] | None = None,
        parallel: int = 4,
    ):
        self.spark, self.graph, self.root, self.n_buckets = spark, graph, root.rstrip("/"), n_buckets
        self.after_node, self.parallel = after_node, parallel
        self._schemas: dict[str, T.StructType] = {
            s.name: T.StructType([*s.schema.fields, *STORAGE_FIELDS]) for s in graph.sources.values()
        }
        for node in graph.nodes.values():
            inputs = [spark.createDataFrame([], self._schemas[i]) for i in node.inputs]
            built = self._stored(node, node.build(*inputs))
            self._schemas[node.name] = T.StructType([*built.schema.fields, T.StructField(LIVE, T.BooleanType())])
        self._fix_buckets()
        for name in self._schemas:  # a table that was never written is an empty folder
            files.make_folder(spark, self.path(name))
        self._one_walk = Lock()
        self._journal = Journal(spark, f"{self.root}/_state/history", HISTORY_FILE)
        self._triggers = Journal(spark, f"{self.root}/_state/triggers", TRIGGERS)
        self._watch: TriggerWatch | None = None

    def _fix_buckets(self) -> None:
        """Note the number of buckets with the store, and refuse another one later: rows would be looked for elsewhere."""
        path = f"{self.root}/_state/settings.json"
        if files.write_text(self.spark, path, json.dumps({"n_buckets": self.n_buckets}), replace=False):
            return
        known = json.loads(files.read_text(self.spark, path))["n_buckets"]
        if known != self.n_buckets:
            raise ValueError(f"the store at {self.root} has {known} buckets, not {self.n_buckets}")

    def _in_parallel(self, work: Callable, items: list) -> list:
        """Run Spark jobs that do not depend on each other side by side; they share the cluster."""
        with ThreadPoolExecutor(max_workers=self.parallel) as pool:
            return list(pool.map(inheritable_thread_target(self.spark)(work), items))

    # --- storage ---

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _partitions(self, name: str) -> list[str]:
        return {CELL: ["bucket", "slice"], BUCKET: ["bucket"], WHOLE: []}[self.graph.grain_of(name)]

    def _read(self, name: str, cells: DataFrame | None = None, whole_buckets: bool = False) -> DataFrame:
        """Stored rows; with cells, those of their folders only, which a join on the folder columns picks out."""
        df = self.spark.read.schema(self._schemas[name]).parquet(self.path(name))
        if cells is not None:
            on = ["bucket"] if whole_buckets else self._partitions(name)
            df = df.join(cells.select(*on), on, "left_semi") if on else df
        return df.where(LIVE).drop(LIVE) if name in self.graph.nodes else df

    def bucket_of(self, key: str | Column) -> Column:
        return F.pmod(F.xxhash64(F.col(key) if isinstance(key, str) else key), F.lit(self.n_buckets)).cast("int")

    def _stored(self, node: Node, df: DataFrame) -> DataFrame:
        if node.grain == BUCKET and "bucket" not in df.columns:
            df = df.withColumn("bucket", self.bucket_of(node.bucket_by))
        missing = set(self._partitions(node.name)) - set(df.columns)
        if missing:
            raise ValueError(f"{node.name} does not hand on {sorted(missing)}")
        return df

    def land(self, source: str, df: DataFrame, slice_: str | None = None) -> None:
        """Append rows to a raw table, to the slice of the current day where none is given.

        The narrow copies go first: they only serve distinct counts, so a row that is written to them twice after a
        failed landing changes nothing.
        """
        label = slice_ or dt.datetime.now(dt.UTC).date().isoformat()
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", label):
            raise ValueError(f"slice {label!r} cannot name a folder")
        spec = self.graph.sources[source]
        for name, columns in [*[(c.name, c.columns) for c in spec.copies], (source, tuple(spec.schema.names))]:
            bucket = self.bucket_of(self.graph.sources[name].bucket_by)
            rows = self._spread(df.select(*columns, bucket.alias("bucket"), F.lit(label).alias("slice")), name)
            if name != source:  # by key, so that looking up few keys reads few pages
                rows = rows.sortWithinPartitions(*STORAGE, self.graph.sources[name].bucket_by)
            rows.write.mode("append").partitionBy(*STORAGE).parquet(self.path(name))

    def _spread(self, df: DataFrame, name: str) -> DataFrame:
        """Gather each cell in few files; a cell that is too large for one task is split at run time."""
        return df.hint("rebalance", *self._partitions(name))

    def table(self, name: str, as_of: dt.date | str | None = None) -> DataFrame:
        """A table as readers see it, with the day-dependent columns worked out for ``as_of``."""
        df = self._read(name).drop(*STORAGE)
        node = self.graph.nodes.get(name)
        return node.view(df, as_of) if node is not None and node.view is not None else df

    # --- refresh ---

    def changes(self, max_files: int | None = None, pace: str | None = None) -> DataFrame:
        """A stream of (source, bucket, slice, key) for every landed row; the key only where some node looks it up."""
        keys = {lk.name: lk.key for n in self.graph.nodes.values() for lk in n.lookups}
        mine = self._of_pace(pace)
        read = {i for n in self.graph.nodes.values() if n.name in mine for i in n.inputs}
        parts = []
        for name in [s for s in self.graph.sources if s in read]:
            reader = self.spark.readStream.schema(self._schemas[name])
            if max_files:
                reader = reader.option("maxFilesPerTrigger", max_files)
            key = F.col(keys[name]).cast("string") if name in keys else F.lit(None).cast("string")
            rows = reader.parquet(self.path(name))
            parts.append(rows.select(F.lit(name).alias("source"), *STORAGE, key.alias("key")))
        return reduce(DataFrame.unionByName, parts)

    def paces(self) -> list[str]:
        """The different target lags, the tightest first."""
        return sorted({self.graph.lag_of(n) for n in self.graph.nodes}, key=lag_seconds)

    def _of_pace(self, pace: str | None) -> set[str]:
        """The nodes with that lag (or named after ``ONLY``) and all nodes they are made from; all nodes without one."""
        if pace is not None and pace.startswith(ONLY):
            found = set(pace.removeprefix(ONLY).split())
        else:
            found = {n for n in self.graph.nodes if pace is None or self.graph.lag_of(n) == pace}
        todo = list(found)
        while todo:
            inputs = {i for i in self.graph.nodes[todo.pop()].inputs if i in self.graph.nodes} - found
            found |= inputs
            todo += inputs
        return found

    def _writer(self, pace: str, max_files: int | None):
        if self._watch is None:
            self._watch = TriggerWatch(self._triggers, f"{self.root}|")
            self.spark.streams.addListener(self._watch)
        return (
            self.changes(max_files, pace)
            .writeStream.queryName(f"{self.root}|{pace}")
            .foreachBatch(lambda batch, batch_id: self._on_batch(batch, batch_id, pace))
            .option("checkpointLocation", f"{self.root}/_state/checkpoint/{pace.replace(' ', '-')}")
        )

    def refresh_available(self, max_files: int | None = None, only: Iterable[str] | None = None) -> None:
        """Bring all nodes up to date with the rows landed so far, whatever their lag; or only some and what they are made
        from. What the others have not seen stays for them to read: each choice of tables remembers for itself how far it
        came."""
        wanted = sorted(set(only)) if only is not None else []
        if unknown := [n for n in wanted if n not in self.graph.nodes]:
            raise ValueError(f"unknown tables {unknown}")
        for pace in self.paces() if only is None else [ONLY + " ".join(wanted)] * bool(wanted):
            query = self._writer(pace, max_files).trigger(availableNow=True).start()
            try:
                query.awaitTermination()
            finally:
                self._watch.wait_for(query.runId)

    def start(self, max_files: int | None = None) -> Running:
        """Refresh for as long as the queries run: one query per target lag, triggered at its pace. A lag is thus an
        upper bound also where no more rows arrive. All queries of a store run in one driver, where they take turns."""
        return Running({p: self._writer(p, max_files).trigger(processingTime=p).start() for p in self.paces()})

    def rebuild(self) -> None:
        """Recompute every node from the raw tables, for example after its function changed."""
        kept = {name: self._kept_cells(name, self._cells_of(self._read(name)), None) for name in self.graph.sources}
        touched = {name: cells for name, (cells, n) in kept.items() if n}
        for cells in touched.values():
            self._note_slices(r.slice for r in cells.select("slice").distinct().collect())
        self._walk(touched, {}, None)

    @staticmethod
    def _cells_of(df: DataFrame) -> DataFrame:
        """The cells rows lie in."""
        return df.select(*STORAGE).distinct()

    def _kept_cells(self, name: str, cells: DataFrame, pace: str | None) -> tuple[DataFrame, int]:
        """Write cells down, so that they are worked out once, and count them while they are written.

        The name stands in the rows and is asked for again: a filter on the small side of a join is what makes Spark
        prune the folders of the large side at run time.
        """
        path = f"{self.root}/_state/cells/{(pace or 'all').replace(' ', '-')}/{name.replace('.', '/')}"
        rows = cells.select(F.lit(name).alias("of"), F.col("bucket").cast("int"), F.col("slice").cast("string"))
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
        kept = self.spark.read.schema(CELLS).parquet(path).where(F.col("of") == name)
        return kept.select(*STORAGE), seen.get["n"]

    def _on_batch(self, batch: DataFrame, batch_id: int, pace: str) -> None:
        with self._one_walk:  # what is written down for a walk stays as it is until the walk is over
            state = f"{self.root}/_state/changed/{pace.replace(' ', '-')}"
            batch.distinct().write.mode("overwrite").partitionBy("source").parquet(state)
            rows = self.spark.read.schema(CHANGED).parquet(state)
            # At most the sources of the graph, and the slices that got rows.
            present = {r.source: r.slices for r in rows.groupBy("source").agg(F.collect_set("slice").alias("slices")).collect()}
            self._note_slices(s for slices in present.values() for s in slices)
            touched = {name: self._cells_of(rows.where(F.col("source") == name)) for name in present}
            looked_up = {lk.name for n in self.graph.nodes.values() for lk in n.lookups}
            keys = {name: rows.where(F.col("source") == name).select("key").distinct() for name in looked_up & set(present)}
            self._walk_levels(touched, keys, batch_id, pace)

    def _walk(
        self, touched: dict[str, DataFrame], keys: dict[str, DataFrame], batch_id: int | None, pace: str | None = None
    ) -> None:
        """Refresh level by level. Every refresh, failed ones too, leaves a history row; the first failure is raised."""
        with self._one_walk:
            self._walk_levels(touched, keys, batch_id, pace)

    def _walk_levels(
        self, touched: dict[str, DataFrame], keys: dict[str, DataFrame], batch_id: int | None, pace: str | None
    ) -> None:
        cells: dict[str, DataFrame | None] = dict(touched)
        mine = self._of_pace(pace)
        history: list[dict] = []
        failure: Exception | None = None
        for level in self.graph.levels():
            due = []
            for node in level:
                changed = {i: cells[i] for i in node.inputs if cells.get(i) is not None}
                if changed and node.name in mine:
                    due.append((node, changed, keys, pace))
            for node, reached, n_cells, start, end, error in self._in_parallel(lambda args: self._refresh(*args), due):
                state, message = ("SUCCEEDED", None) if error is None else ("FAILED", str(error).split("\n", 1)[0])
                history.append({"name": node.name, "state": state, "state_message": message, "batch_id": batch_id,
                                "touched_cells": n_cells, "start_us": micros(start), "end_us": micros(end)})
                cells[node.name] = reached
                failure = failure or error
            if failure is not None:
                break
        if history:
            self._journal.add(history)
        if failure is not None:
            raise failure

    def _refresh(self, node: Node, changed: dict[str, DataFrame], keys: dict[str, DataFrame], pace: str | None) -> tuple:
        start = dt.datetime.now(dt.UTC)
        cells: DataFrame | None = None
        n_cells = 0
        error: Exception | None = None
        try:
            cells = self._reached(node, changed, keys, pace)
            if cells is not None:
                n_cells = self._recompute(node, cells, pace)
                if node.merge is not None:
                    self._roll_up(node, cells)
                if self.after_node is not None:
                    self.after_node(self, node.name)
        except Exception as exc:
            error = exc
        return node, cells, n_cells, start, dt.datetime.now(dt.UTC), error

    def _reached(self, node: Node, changed_inputs: dict[str, DataFrame], keys: dict[str, DataFrame], pace: str | None) -> DataFrame | None:
        """The cells of a node that its changed inputs reach; None if there are none.

        Where a node follows one input, its cells are those of the input and nothing has to be worked out.
        """
        aligned = [changed_inputs[i].select(*STORAGE) for i in node.aligned_inputs if i in changed_inputs]
        due = [lk for lk in node.lookups if lk.name in changed_inputs and files.filled(self.spark, self.path(lk.of))]
        looked_up = [self._cells_that_look_up(lk, changed_inputs[lk.name], keys.get(lk.name), pace) for lk in due]
        if not aligned and not looked_up:
            return None  # no row refers to what has changed
        if not looked_up and len(aligned) == 1 and node.grain == CELL:
            return aligned[0]
        parts = self._partitions(node.name)
        kept = [F.col(c) if c in parts else F.lit(None).cast(t).alias(c) for c, t in zip(STORAGE, ("int", "string"), strict=True)]
        cells = reduce(DataFrame.unionByName, aligned + looked_up).select(*kept).distinct()
        if not looked_up:
            return cells
        cells, n = self._kept_cells(node.name, cells, pace)
        return cells if n else None

    def _cells_that_look_up(self, lk: Lookup, changed_cells: DataFrame, keys: DataFrame | None, pace: str | None) -> DataFrame:
        """The cells of ``lk.of`` with a row that refers to a changed row of ``lk.name``."""
        if keys is None:
            keys = self._read(lk.name, changed_cells).select(F.col(lk.key).cast("string").alias("key"))
        if lk.by is not None:
            return self._cells_of_keys(lk.by, keys, f"{lk.of}-by", pace)
        rows = self._read(lk.of, changed_cells if lk.same_bucket else None, whole_buckets=True)
        rows = rows.select(F.col(lk.column).cast("string").alias("key"), *STORAGE)
        return self._cells_of(rows.join(keys, "key", "left_semi"))

    def _cells_of_keys(self, copy: str, keys: DataFrame, label: str, pace: str | None) -> DataFrame:
        """The cells in which some keys stand, from the copy that is stored by that key: of it only the buckets of these
        keys are read. The keys are written down first, so that they are worked out once."""
        spec = self.graph.sources[copy]
        key = F.col("key").cast(spec.schema[spec.bucket_by].dataType)
        path = f"{self.root}/_state/keys/{(pace or 'all').replace(' ', '-')}/{label.replace('.', '/')}"
        rows = keys.where(F.col("key").isNotNull()).distinct()
        rows.select(F.lit(label).alias("of"), "key", self.bucket_of(key).alias("bucket")).write.mode("overwrite").parquet(path)
        wanted = self.spark.read.schema("of string, key string, bucket int").parquet(path).where(F.col("of") == label)
        found = self._read(copy, wanted.select("bucket").distinct(), whole_buckets=True)
        found = found.join(wanted.select(key.alias(spec.bucket_by)), spec.bucket_by, "left_semi")
        return found.select(self.bucket_of(self.graph.copied_from[copy].bucket_by).alias("bucket"), "slice").distinct()

    def _looked_up(self, node: Node, lk: Lookup, cells: DataFrame, pace: str | None) -> DataFrame:
        """The rows a node may look up for some of its cells: those in the cells where its keys stand, where a copy tells
        them, else all."""
        if lk.at is None:
            return self._read(lk.name)
        rows = self._read(lk.of, cells)
        keys = (rows.where(lk.where) if lk.where else rows).select(F.col(lk.column).cast("string").alias("key"))
        label = f"{node.name}-of-{lk.name}"
        held, _ = self._kept_cells(label, self._cells_of_keys(lk.at, keys, f"{label}-at", pace), pace)
        return self._read(lk.name, held)

    def _recompute(self, node: Node, cells: DataFrame, pace: str | None) -> int:
        """Replace the rows of some cells of a node; how many cells there were."""
        lookups = {lk.name: lk for lk in node.lookups}

        def frame(name: str) -> DataFrame:
            if node.grain == WHOLE:
                return self._read(name)
            if name in lookups and not lookups[name].same_bucket:
                return self._looked_up(node, lookups[name], cells, pace)
            if node.grain == BUCKET and name in self.graph.nodes and self.graph.nodes[name].merge is not None:
                return self._read_merged(name, cells)
            return self._read(name, cells, whole_buckets=name in lookups or node.grain == BUCKET)

        built = self._stored(node, node.build(*[frame(i) for i in node.inputs])).withColumn(LIVE, F.lit(True))
        schema, parts = self._schemas[node.name], self._partitions(node.name)
        out = built.select(*schema.names)
        if not parts:
            out.write.mode("overwrite").parquet(self.path(node.name))
            return 1
        marked = out.unionByName(self._markers(cells, schema, parts))
        # Rows that only change their columns lie together as they did before.
        return self._replace_parts(marked if node.in_place else self._spread(marked, node.name), parts, self.path(node.name))

    # A cell that lost all its rows must be replaced too, so each one gets a marker row readers never see.
    @staticmethod
    def _markers(cells: DataFrame, schema: T.StructType, parts: list[str]) -> DataFrame:
        values = {f.name: F.lit(False if f.name == LIVE else None).cast(f.dataType) for f in schema}
        return cells.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in parts else values[f.name].alias(f.name) for f in schema])

    @staticmethod
    def _replace_parts(rows: DataFrame, parts: list[str], path: str) -> int:
        """Replace the folders that the rows lie in; how many markers there were."""
        seen = Observation()
        (
            rows.observe(seen, F.count_if(~F.col(LIVE)).alias("n"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts)
            .parquet(path)
        )
        return seen.get["n"]

    # --- levels ---

    @property
    def _slices_path(self) -> str:
        return f"{self.root}/_state/slices.json"

    def _slices(self) -> list[str]:
        """All slices in the order they first came."""
        path = self._slices_path
        return json.loads(files.read_text(self.spark, path)) if files.exists(self.spark, path) else []

    def _note_slices(self, came: Iterable[str]) -> None:
        known = self._slices()
        new = sorted(set(came) - set(known))
        if new:
            files.write_text(self.spark, self._slices_path, json.dumps(known + new))

    def _levels_path(self, name: str) -> str:
        return f"{self.path(name)}.levels"

    def _sealed(self, name: str) -> int:
        """How many of the first slices are rolled up."""
        path = f"{self.root}/_state/sealed/{name}.json"
        return json.loads(files.read_text(self.spark, path)) if files.exists(self.spark, path) else 0

    def _roll_up(self, node: Node, cells: DataFrame) -> None:
        """Bring the groups above some cells up to date and make those that have become full.

        A group that is there is redone for the buckets of the cells, a new one is made for all buckets. Only when both
        are written do readers count on the new ones. Everything is worked out from the rows below, never added to what is
        there, so a walk that is repeated ends in the same.
        """
        slices, sealed = self._slices(), self._sealed(node.name)
        full = len(slices) // FAN * FAN
        place = {s: i for i, s in enumerate(slices)}
        touched = sorted({place[r.slice] for r in cells.select("slice").distinct().collect() if place.get(r.slice, full) < full})
        level = 1
        while FAN**level <= full:
            size = FAN**level
            old = sorted({i // size for i in touched if (i // size + 1) * size <= sealed})
            new = list(range(sealed // size, full // size))
            for groups, buckets in ((old, cells.select("bucket").distinct()), (new, None)):
                if groups:
                    self._make_groups(node, level, groups, buckets, slices)
            level += 1
        if full > sealed:
            files.write_text(self.spark, f"{self.root}/_state/sealed/{node.name}.json", json.dumps(full))

    def _make_groups(self, node: Node, level: int, groups: list[int], buckets: DataFrame | None, slices: list[str]) -> None:
        """Merge the slices (or groups of the level below) of some groups, for some buckets or all."""
        if level == 1:
            place = {s: i for i, s in enumerate(slices)}
            members = [s for g in groups for s in slices[g * FAN : (g + 1) * FAN]]
            numbers = self.spark.createDataFrame([(s, place[s] // FAN) for s in members], "slice string, grp int")
            rows = self._read(node.name, buckets, whole_buckets=True) if buckets is not None else self._read(node.name)
            rows = rows.where(F.col("slice").isin(members)).join(numbers, "slice").drop("slice")
        else:
            rows = self._read_groups(node.name, level - 1, [g * FAN + i for g in groups for i in range(FAN)], buckets)
            rows = rows.withColumn("grp", (F.col("grp") / FAN).cast("int"))
        merged = node.merge(rows.withColumn("level", F.lit(level)), ("bucket", "level", "grp")).withColumn(LIVE, F.lit(True))
        schema, parts = self._level_schema(node.name), [f.name for f in LEVEL_FIELDS]
        out = merged.select(*schema.names)
        if buckets is not None:
            redone = buckets.select("bucket", F.lit(level).alias("level"), F.explode(F.array(*[F.lit(g) for g in groups])).alias("grp"))
            out = out.unionByName(self._markers(redone, schema, parts))
        self._replace_parts(out.hint("rebalance", *parts), parts, self._levels_path(node.name))

    def _level_schema(self, name: str) -> T.StructType:
        stored = {f.name for f in STORAGE_FIELDS}
        return T.StructType([*[f for f in self._schemas[name] if f.name not in stored], *LEVEL_FIELDS])

    def _read_groups(self, name: str, level: int, groups: list[int], buckets: DataFrame | None) -> DataFrame:
        rows = self.spark.read.schema(self._level_schema(name)).parquet(self._levels_path(name))
        rows = rows.where((F.col("level") == level) & F.col("grp").isin(groups))
        if buckets is not None:
            rows = rows.join(buckets.select("bucket").distinct(), "bucket", "left_semi")
        return rows.where(LIVE).drop(LIVE)

    @staticmethod
    def cover(sealed: int) -> dict[int, list[int]]:
        """The fewest groups, by level, that hold the first ``sealed`` slices."""
        out: dict[int, list[int]] = {}
        at = 0
        while at < sealed:
            level = 1
            while at % FAN ** (level + 1) == 0 and at + FAN ** (level + 1) <= sealed:
                level += 1
            out.setdefault(level, []).append(at // FAN**level)
            at += FAN**level
        return out

    def _read_merged(self, name: str, cells: DataFrame) -> DataFrame:
        """All rows of the buckets of some cells, from groups as far as slices are rolled up, else from the slices."""
        sealed, columns = self._sealed(name), [f.name for f in self._schemas[name] if f.name != LIVE]
        rows = self._read(name, cells.select("bucket").distinct(), whole_buckets=True)
        rows = rows.where(~F.col("slice").isin(self._slices()[:sealed])) if sealed else rows
        for level, groups in self.cover(sealed).items():
            more = self._read_groups(name, level, groups, cells)
            rows = rows.select(*columns).unionByName(more.withColumn("slice", F.lit(None).cast("string")).select(*columns))
        return rows

    # --- history ---

    def history(self, n: int = 20) -> DataFrame:
        """The newest refreshes of all nodes with their duration in seconds."""
        return latest(refresh_history(self.spark, self.root), n, "refresh_start_time", "name")

    def triggers(self, n: int = 20) -> DataFrame:
        """The newest triggers of all queries of the store, those that failed or had nothing to do included."""
        return latest(shown(self._triggers.read()), n, "at", "pace")


def refresh_history(spark: SparkSession, root: str) -> DataFrame:
    rows = Journal(spark, f"{root}/_state/history", HISTORY_FILE).read()
    times = {"refresh_start_time": "start_us", "refresh_end_time": "end_us"}
    shown = rows.select(
        *[F.timestamp_micros(times[f.name]).cast(f.dataType).alias(f.name) if f.name in times else F.col(f.name).cast(f.dataType) for f in REFRESH_HISTORY]
    )
    seconds = second_boundaries(F.col("refresh_start_time"), F.col("refresh_end_time"))
    return shown.withColumn("refresh_seconds", seconds)

