"""The structured run log and the views over it."""

from __future__ import annotations

import datetime as dt
import json
import threading
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.dates import hour_floor, second_boundaries, within_minutes
from wardflow.functions.details import detail_field, has_field
from wardflow.functions.flags import health_status
from wardflow.functions.text import message_template, split_prefix
from wardflow.sources.schemas import RUN_LOG
from wardflow.sources.tables import append, read, rows_frame


class RunLog:
    """Collects the events of a run and appends them in one write, so that a run leaves one small file, not many."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target
        self._events: list[tuple] = []
        self._lock = threading.Lock()

    def event(
        self, run_id: str, step: str, level: str, message: str, detail: dict[str, Any] | None = None
    ) -> None:
        now = dt.datetime.now(dt.UTC).replace(tzinfo=None).isoformat(sep=" ")
        text = None if detail is None else json.dumps(detail, separators=(",", ":"))
        with self._lock:
            self._events.append((run_id, step, level.upper(), message, text, now))

    def flush(self) -> None:
        with self._lock:
            events, self._events = self._events, []
        if events:
            append(rows_frame(self.spark, events, RUN_LOG).coalesce(1), self.target)

    def read(self) -> DataFrame:
        return read(self.spark, self.target)

    def __enter__(self) -> RunLog:
        return self

    def __exit__(self, *exc: object) -> None:
        self.flush()


def log_event(
    spark: SparkSession,
    target: str,
    run_id: str,
    step: str,
    level: str,
    message: str,
    detail: dict[str, Any] | None = None,
) -> str:
    """Append one event at once."""
    with RunLog(spark, target) as log:
        log.event(run_id, step, level, message, detail)
    return "LOGGED"


def make_run_id(batch_id: str, now: dt.datetime | None = None) -> str:
    stamp = (now or dt.datetime.now(dt.UTC)).replace(tzinfo=None)
    return f"{batch_id}-{str(stamp).replace(' ', 'T')}"


# --- views -----------------------------------------------------------------------------------------------------------


# The output columns of the views and the health rule are fixed values. The order is for people who look at
# a view; jobs that read on cannot rely on one and ask for the rows unsorted.


def run_summary(log: DataFrame, ordered: bool = True) -> DataFrame:
    """Events per hour, step and level with first and last time."""
    out = (
        log.groupBy(hour_floor(F.col("logged_at")).alias("log_hour"), "step_name", "log_level")
        .agg(
            F.count("*").alias("event_count"),
            F.min("logged_at").alias("first_event"),
            F.max("logged_at").alias("last_event"),
        )
    )
    return out.orderBy(F.col("log_hour").desc_nulls_first(), F.col("log_level").asc_nulls_last()) if ordered else out


def batch_health(log: DataFrame, batch: str | None = None, ordered: bool = True) -> DataFrame:
    """Level counts, status and duration per batch.

    A batch is the first two parts of the run id, or the given column where the log carries a real batch id.
    """
    key = F.col(batch) if batch else split_prefix(F.col("run_id"))
    level = F.col("log_level")
    counts = log.groupBy(key.alias("batch_prefix")).agg(
        F.count_if(level == "INFO").alias("info_count"),
        F.count_if(level == "WARN").alias("warn_count"),
        F.count_if(level == "ERROR").alias("error_count"),
        F.min("logged_at").alias("started_at"),
        F.max("logged_at").alias("ended_at"),
    )
    out = counts.select(
        *["batch_prefix", "info_count", "warn_count", "error_count"],
        health_status(F.col("error_count"), F.col("warn_count")).alias("health_status"),
        *["started_at", "ended_at"],
        second_boundaries(F.col("started_at"), F.col("ended_at")).alias("duration_sec"),
    )
    return out.orderBy(F.col("started_at").desc_nulls_first()) if ordered else out


def import_details(log: DataFrame, ordered: bool = True) -> DataFrame:
    """Typed details of the import events, newest first if ordered."""
    return _details(log, "rows_loaded", ordered, rows_loaded="decimal(38,0)", target="string", batch_id="string").withColumnRenamed(
        "target", "target_table"
    )


def quarantine_details(log: DataFrame, ordered: bool = True) -> DataFrame:
    """Typed details of the routing events, newest first if ordered."""
    return _details(log, "quarantined", ordered, accepted="decimal(38,0)", quarantined="decimal(38,0)", batch_id="string")


def _details(log: DataFrame, key: str, ordered: bool, **fields: str) -> DataFrame:
    detail = F.col("detail")
    out = log.where(detail.isNotNull() & has_field(detail, key)).select(
        "run_id", "message", *[detail_field(detail, k, t).alias(k) for k, t in fields.items()], "logged_at"
    )
    return (out.orderBy(F.col("logged_at").desc_nulls_first()) if ordered else out).drop("logged_at")


def problem_events(log: DataFrame, ordered: bool = True) -> DataFrame:
    """Warnings and errors, newest first if ordered."""
    out = log.where(F.col("log_level").isin("WARN", "ERROR"))
    out = out.select("run_id", "step_name", "log_level", "message", "logged_at")
    return out.orderBy(F.col("logged_at").desc_nulls_first()) if ordered else out


def events_of(log: DataFrame, run_id: str) -> DataFrame:
    return log.where(F.col("run_id") == run_id)


def recent_errors(log: DataFrame, minutes: int = 5, now: dt.datetime | str | None = None) -> DataFrame:
    return log.where((F.col("log_level") == "ERROR") & within_minutes(F.col("logged_at"), minutes, now))


def has_recent_errors(log: DataFrame, minutes: int = 5, now: dt.datetime | str | None = None) -> bool:
    """Whether any error falls in the look-back; stops at the first one found."""
    return not recent_errors(log, minutes, now).isEmpty()


def error_patterns(
    log: DataFrame, n: int | None = None, levels: tuple[str, ...] = ("ERROR",), ordered: bool = True
) -> DataFrame:
    """Messages grouped by their template with counts and times; with n, the n most frequent ones."""
    out = (
        log.where(F.col("log_level").isin(*levels))
        .groupBy(message_template(F.col("message")).alias("template"))
        .agg(
            F.count("*").alias("event_count"),
            F.min("logged_at").alias("first_event"),
            F.max("logged_at").alias("last_event"),
        )
    )
    if ordered or n is not None:
        out = out.orderBy(F.col("event_count").desc(), F.col("template").asc_nulls_last())
    return out if n is None else out.limit(n)
