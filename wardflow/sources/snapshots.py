"""Parquet tables that change as a whole: a version is written to folders of its own and takes effect by one small file.

    root/_run=<id>/...        rows of one write, never changed afterwards
    root/_versions/<n>.json   which folders (and, after a merge, which of their files) make up version n

Readers look up the newest version and read what it names. A write that fails leaves no version, so the rows before it
stay readable; what it left behind is removed. Of two writers that finish at the same time one creates the next version
and the other one notices: replacing tries the number after that, adding and merging start over from the new version.
On file systems with an atomic rename (HDFS, local disks) that holds without exception; on a plain object store two
writers of one table must not finish at the same instant.

Versions before the newest ``keep`` are dropped after the switch; queries that read one of those fail. The folders of
versions still kept are never touched.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.sources import files

RUN, VERSIONS = "_run", "_versions"
KEEP = 2  # the version in force and the one before it, which running queries may still read
ATTEMPTS = 5

# What is written down with a version: values, or a function that takes them from all its rows before it takes effect.
Note = Mapping | Callable[[DataFrame], Mapping] | None


class Conflict(RuntimeError):
    """Other writers kept changing the table."""


@dataclass(frozen=True)
class Version:
    number: int
    runs: tuple[str, ...]  # whole folders, but for those in ``parts``
    parts: Mapping[str, Sequence[str]]  # folder -> the files of it that still count
    schema: str
    partition_by: tuple[str, ...]
    rows_written: int
    at: str
    note: Mapping[str, str] = field(default_factory=dict)

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def folders(self) -> set[str]:
        return {*self.runs, *self.parts}

    def paths(self, root: str) -> list[str]:
        whole = [f"{root}/{RUN}={r}" for r in self.runs]
        return whole + [f"{root}/{RUN}={r}/{name}" for r, kept in self.parts.items() for name in kept]


def parsed(text: str) -> Version:
    raw = json.loads(text)
    return Version(**{**raw, "runs": tuple(raw["runs"]), "partition_by": tuple(raw["partition_by"])})


def _is_file(name: str) -> bool:
    return name.endswith(".json") and name[:-5].isdigit()


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, keep: int = KEEP):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), max(1, keep)

    # --- versions ---

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in files.names(self.spark, f"{self.root}/{VERSIONS}") if _is_file(n))

    def _path_of(self, number: int) -> str:
        return f"{self.root}/{VERSIONS}/{number:020d}.json"

    def version(self, number: int) -> Version:
        return parsed(files.read_text(self.spark, self._path_of(number)))

    def latest(self) -> Version | None:
        numbers = self._numbers()
        return self.version(numbers[-1]) if numbers else None

    def versions(self) -> list[Version]:
        """The versions that can still be read, the oldest first."""
        return [self.version(n) for n in self._numbers()]

    def _commit(self, version: Version) -> bool:
        return files.write_text(self.spark, self._path_of(version.number), json.dumps(asdict(version)), replace=False)

    # --- reading ---

    def read(self, version: Version | int | None = None) -> DataFrame:
        """The rows of the newest version, or of another one that is still kept."""
        found = self.latest() if version is None else version if isinstance(version, Version) else self.version(version)
        if found is None:
            raise FileNotFoundError(f"{self.root} has no version")
        return self.frame(found, found.paths(self.root)).select(*found.struct().names)

    def frame(self, version: Version, paths: list[str]) -> DataFrame:
        schema = version.struct()
        if not paths:
            return self.spark.createDataFrame([], schema)
        with_run = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
        return self.spark.read.schema(with_run).option("basePath", self.root).parquet(*paths)

    # --- writing ---

    def written(self, df: DataFrame, partition_by: Sequence[str]) -> tuple[str, int]:
        """Write rows to a folder of their own: its name and their number, for ``adopt``; nothing of them stays where the write fails."""
        run, seen = uuid.uuid4().hex, Observation()
        try:
            writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.root}/{RUN}={run}")
        except BaseException:
            self._drop_run(run)
            raise
        return run, seen.get["n"]

    def _drop_run(self, run: str) -> None:
        files.delete(self.spark, f"{self.root}/{RUN}={run}")

    def _next(self, after: int, schema: T.StructType, partition_by: Sequence[str], runs: Sequence[str], parts: Mapping, n: int, note: Note = None) -> Version:
        at = dt.datetime.now(dt.UTC).isoformat()
        made = Version(after + 1, tuple(runs), dict(parts), json.dumps(schema.jsonValue()), tuple(partition_by), n, at)
        values = note(self.read(made)) if callable(note) else note
        return replace(made, note={k: str(v) for k, v in (values or {}).items()})

    def replace(self, df: DataFrame, partition_by: Sequence[str] = (), note: Note = None) -> Version:
        """All rows anew, whatever the table held; the query may read the table itself."""
        run, n = self.written(df, partition_by)
        return self.adopt(run, df.schema, partition_by, n, note)

    def adopt(self, run: str, schema: T.StructType, partition_by: Sequence[str], n: int, note: Note = None) -> Version:
        """Make a folder that was written before the whole table."""
        while True:
            numbers = self._numbers()
            version = self._next(numbers[-1] if numbers else 0, schema, partition_by, [run], {}, n, note)
            if self._commit(version):
                self.drop_old()
                return version

    def clear(self, note: Note = None) -> Version | None:
        """Make the table empty; None where there is no table."""
        while (last := self.latest()) is not None:
            version = self._next(last.number, last.struct(), last.partition_by, [], {}, 0, note)
            if self._commit(version):
                self.drop_old()
                return version
        return None

    def append(self, df: DataFrame, note: Note = None) -> Version:
        """More rows. The columns are those of the table."""
        last = self.latest()
        if last is None:
            return self.replace(df, note=note)
        schema = last.struct()
        run, n = self.written(df.select(*[F.col(f.name).cast(f.dataType) for f in schema]), last.partition_by)
        for _ in range(ATTEMPTS):
            version = self._next(last.number, schema, last.partition_by, [*last.runs, run], last.parts, n, note or last.note)
            if self._commit(version):
                self.drop_old()
                return version
            last = self.latest()
        self._drop_run(run)
        raise Conflict(f"{self.root}: not added after {ATTEMPTS} attempts")

    def merge(self, df: DataFrame, keys: Sequence[str], note: Note = None) -> Version:
        """Rows by key: those of a key that comes are replaced by what comes, other keys stay, new ones are added.

        Only files that hold a key that comes are written anew; of all others nothing but the key columns is read, once.
        NULL is a key like any other, and a key may come with several rows, so a batch that is merged twice changes
        nothing. The files of a partly kept folder are listed in the version.
        """
        if not keys:
            raise ValueError("a merge needs key columns")
        last = self.latest()
        if last is None:
            return self.replace(df, note=note)
        schema = last.struct()
        incoming = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        run, n = self.written(incoming, last.partition_by)
        arrived = self.spark.read.schema(schema).parquet(f"{self.root}/{RUN}={run}").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
        for _ in range(ATTEMPTS):
            rest = self._without_keys(last, arrived, keys)
            runs, parts = rest.runs, rest.parts
            version = self._next(last.number, schema, last.partition_by, [*runs, run], parts, n + rest.rows_written, note or last.note)
            if self._commit(version):
                self.drop_old()
                return version
            for fresh in {*runs} - last.folders():
                self._drop_run(fresh)
            last = self.latest()
        self._drop_run(run)
        raise Conflict(f"{self.root}: not merged after {ATTEMPTS} attempts")

    def _without_keys(self, last: Version, arrived: DataFrame, keys: Sequence[str]) -> Version:
        """The version less the rows of some keys; files without any of them are taken over as they are."""
        if not last.folders():
            return self._next(last.number, last.struct(), last.partition_by, [], {}, 0)
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
        stored = self.frame(last, last.paths(self.root))
        held = stored.select(*keys, F.col("_metadata.file_path").alias("_file")).join(arrived, same, "left_semi")
        touched = {self._local(r[0]) for r in held.select("_file").distinct().toLocalIterator()}  # names of files, as Spark lists them
        if not touched:
            return last
        kept: dict[str, list[str]] = {}
        for run, name in sorted({self._local(f) for f in stored.inputFiles()} - touched):
            kept.setdefault(run, []).append(name)
        broken = {run for run, _ in touched}
        old = self.frame(last, [f"{self.root}/{RUN}={r}/{name}" for r, name in sorted(touched)])
        fresh, n = self.written(old.join(arrived, same, "left_anti").select(*last.struct().names), last.partition_by)
        parts = {r: kept[r] for r in {*broken, *last.parts} if r in kept}
        return self._next(last.number, last.struct(), last.partition_by, [*[r for r in last.runs if r not in broken], fresh], parts, n)

    def _local(self, path: str) -> tuple[str, str]:
        """Folder and name within it of a file as Spark names it."""
        run, _, name = unquote(path).rpartition(f"/{RUN}=")[2].partition("/")
        return run, name

    def drop_old(self) -> None:
        """Remove versions before the newest ``keep``, and folders that no version left names any more."""
        numbers = self._numbers()
        old, new = numbers[: -self.keep], numbers[-self.keep :]
        if not old:
            return
        needed = {r for n in new for r in self.version(n).folders()}
        for number in old:
            gone = self.version(number).folders() - needed
            # The pointer goes first: a version that is listed can be read.
            files.delete(self.spark, self._path_of(number))
            for run in gone:
                self._drop_run(run)


def newest_versions(spark: SparkSession, roots: str) -> list[tuple[str, Version]]:
    """Root and newest version of every table whose root matches a pattern: one row per table comes to the driver."""
    try:
        texts = spark.read.option("wholetext", True).text(f"{roots}/{VERSIONS}")
    except AnalysisException:  # no table yet
        return []
    path = F.col("_metadata.file_path")
    last = texts.where(path.endswith(".json")).select(F.regexp_extract(path, f"^(.*)/{VERSIONS}/", 1).alias("root"), path.alias("path"), "value")
    found = last.groupBy("root").agg(F.max_by("value", "path").alias("value")).collect()
    return sorted((unquote(r.root), parsed(r.value)) for r in found)


def is_snapshot(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path.rstrip('/')}/{VERSIONS}")
