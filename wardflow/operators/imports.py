"""Configuration-driven imports with a status per source."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from wardflow.operators.runlog import RunLog, make_run_id
from wardflow.sources.schemas import IMPORT_STATUS
from wardflow.sources.tables import append, ctas, read, rows_frame, with_lineage

STEP = "RUN_IMPORT"


@dataclass(frozen=True)
class ImportResult:
    source_table: str
    status: str  # SUCCESS, FAILED, DISABLED or UNKNOWN
    message: str
    target: str | None = None
    rows_loaded: int | None = None


def _catalog_name(schema: str, table: str) -> str:
    return f"{schema}.{table}"


class Importer:
    """Runs the imports a configuration lists. ``locate`` turns schema and table into a table name or a path."""

    def __init__(
        self,
        spark: SparkSession,
        config: DataFrame,
        log: RunLog,
        status_target: str,
        locate: Callable[[str, str], str] = _catalog_name,
    ):
        self.spark, self.config, self.log = spark, config, log
        self.status_target, self.locate = status_target, locate

    def _entries(self, condition=None) -> list[Row]:
        """Declarations made by people, one import each, in order."""
        rows = self.config if condition is None else self.config.where(condition)
        return list(rows.orderBy("config_id").toLocalIterator())

    def get_config(self, source_table: str) -> list[Row]:
        """The enabled entries of a source, or its disabled ones where none is enabled."""
        rows = self._entries(F.col("source_table") == source_table)
        return [r for r in rows if r.enabled] or rows[:1]

    def run_import(self, source_table: str, batch_id: str, loaded_at: dt.datetime | None = None) -> ImportResult:
        """Copy one configured source into each of its enabled targets with load time and batch id; errors end in status
        FAILED. Where there are several targets, the first failure is the result, else the first success."""
        entries = self.get_config(source_table) or [None]
        results = [self._import(e, source_table, batch_id, loaded_at) for e in entries]
        self._stamp(results)
        self.log.flush()
        return next((r for r in results if r.status == "FAILED"), results[0])

    def run_all_imports(
        self, batch_id: str, loaded_at: dt.datetime | None = None, parallel: int = 4
    ) -> list[ImportResult]:
        """Import every enabled source in configuration order, a few Spark jobs at a time."""
        entries = self._entries(F.col("enabled"))
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            runs = [pool.submit(self._import, e, e.source_table, batch_id, loaded_at) for e in entries]
            results = [r.result() for r in runs]
        self._stamp(results)
        self.log.flush()
        return results

    def _import(self, entry: Row | None, source: str, batch_id: str, loaded_at: dt.datetime | None) -> ImportResult:
        if entry is None:
            return ImportResult(source, "UNKNOWN", f"{source} is not configured")
        if not entry.enabled:
            return ImportResult(source, "DISABLED", f"{source} is disabled")
        # The step name, the log messages and the texts of the results below are fixed values.
        run = make_run_id(batch_id)
        origin = f"{entry.source_schema}.{source}"
        target = f"{entry.target_schema}.{entry.target_table}"
        self.log.event(
            run, STEP, "INFO", f"Starting import of {source}", {"source": origin, "target": target, "batch_id": batch_id}
        )
        try:
            seen = Observation()
            rows = read(self.spark, self.locate(entry.source_schema, source))
            loaded = with_lineage(rows, batch_id, loaded_at).observe(seen, F.count("*").alias("n"))
            ctas(loaded, self.locate(entry.target_schema, entry.target_table))
            count = seen.get["n"]
        except Exception as exc:
            text = f"Import failed: {str(exc).splitlines()[0]}"
            self.log.event(run, STEP, "ERROR", text)
            return ImportResult(source, "FAILED", text, target)
        self.log.event(
            run,
            STEP,
            "INFO",
            f"Completed import of {source}",
            {"target": target, "rows_loaded": count, "batch_id": batch_id},
        )
        return ImportResult(source, "SUCCESS", f"SUCCESS: Loaded into {target}", target, count)

    def _stamp(self, results: list[ImportResult]) -> None:
        now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
        rows = [(r.source_table, now, r.status) for r in results if r.status in ("SUCCESS", "FAILED")]
        if rows:
            append(rows_frame(self.spark, rows, IMPORT_STATUS).coalesce(1), self.status_target)

    def status(self) -> DataFrame:
        try:
            stamps = read(self.spark, self.status_target, IMPORT_STATUS)
        except AnalysisException:  # nothing was imported yet
            stamps = self.spark.createDataFrame([], IMPORT_STATUS)
        return import_status(self.config, stamps)


def mark_run(spark: SparkSession, status_target: str, source_table: str, status: str, now: dt.datetime) -> None:
    """Record a run status; the newest record of a source counts."""
    append(rows_frame(spark, [(source_table, now, status)], IMPORT_STATUS).coalesce(1), status_target)


def import_status(config: DataFrame, stamps: DataFrame) -> DataFrame:
    """Every configured source with its last run."""
    last = stamps.groupBy(F.col("source_table").alias("_source")).agg(
        F.max("last_run_ts").alias("last_run_ts"),
        F.max_by("last_run_status", "last_run_ts").alias("last_run_status"),
    )
    return config.join(last, F.col("source_table") == F.col("_source"), "left").select(
        "source_table", "target_table", "last_run_ts", "last_run_status"
    )


def enabled_imports(config: DataFrame) -> DataFrame:
    return config.where("enabled").orderBy("config_id")


def results_frame(spark: SparkSession, results: list[ImportResult]) -> DataFrame:
    rows = [(r.source_table, r.status, r.target, r.rows_loaded, r.message) for r in results]
    return spark.createDataFrame(
        rows, "source_table string, status string, target string, rows_loaded bigint, message string"
    )
