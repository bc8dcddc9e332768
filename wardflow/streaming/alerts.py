"""Streams over the run log: counts per window, kept current in a table, and alerts that are raised once and cleared."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wardflow.functions.dates import hour_floor
from wardflow.sources.snapshots import SnapshotTable

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SPELL = "first_us bigint, last_us bigint, n bigint"
ALERTS = "key string, event string, at_us bigint, first_us bigint, last_us bigint, error_count bigint"
RAISED, CLEARED = "RAISED", "CLEARED"  # an alert opens, and its look-back has passed without errors


def log_stream(spark, path: str, schema, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def error_alerts(log: DataFrame, minutes: int = 5, late: str = "10 minutes") -> DataFrame:
    """Windows of the log that hold errors, with their number; a stream reports a window once no more late events can
    fall into it.

    On a stream every event moves time forward, not only errors, so windows close while the log is healthy. Only the
    counts of open windows are kept as state.
    """
    is_error = F.col("log_level") == "ERROR"
    if not log.isStreaming:
        log = log.where(is_error)
    return (
        _timed(log, late)
        .groupBy(F.window("event_time", f"{minutes} minutes").alias("w"))
        .agg(F.count_if(is_error).alias("error_count"), F.max(F.when(is_error, F.col("logged_at"))).alias("last_error"))
        .where(F.col("error_count") > 0)
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "error_count",
            "last_error",
        )
    )


def _timed(log: DataFrame, late: str) -> DataFrame:
    """The log with an event time for watermarks, which take zoned timestamps only (the session runs in UTC)."""
    log = log.withColumn("event_time", F.col("logged_at").cast("timestamp"))
    return log.withWatermark("event_time", late) if log.isStreaming else log


def run_summary_stream(log: DataFrame, late: str = "1 hour") -> DataFrame:
    """The hourly run summary as a stream that reports each hour once it is closed."""
    hour = F.window("event_time", "1 hour").alias("w")
    return (
        _timed(log, late)
        .groupBy(hour, "step_name", "log_level")
        .agg(
            F.count("*").alias("event_count"),
            F.min("logged_at").alias("first_event"),
            F.max("logged_at").alias("last_event"),
        )
        .select(
            hour_floor(F.col("w.start")).alias("log_hour"),
            *["step_name", "log_level", "event_count", "first_event", "last_event"],
        )
    )


# --- tables that are always current ---


def keep_current(rows: DataFrame, target: str, checkpoint: str, keys: Sequence[str], every: str | None = "5 minutes") -> StreamingQuery:
    """Keep the newest state of every window of a stream in the table at ``target``.

    What a trigger changes is merged by key as one version, so a window is there after the trigger that saw its first
    row, long before it closes; a trigger that is repeated changes nothing. Without an interval, process what is there
    and stop.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        table = SnapshotTable(batch.sparkSession, target)
        if table.latest() is None or not batch.isEmpty():
            table.merge(batch, keys, {"batch": batch_id})

    writer = rows.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


# --- alerts by step ---


def joined_spells(spells: Iterable[tuple[int, int, int]], quiet_us: int) -> list[tuple[int, int, int]]:
    """(first, last, number) of errors, spells less than ``quiet_us`` apart made one. Any order of joining ends in the same."""
    out: list[tuple[int, int, int]] = []
    for first, last, n in sorted(spells):
        if out and first - out[-1][1] < quiet_us:
            out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + n)
        else:
            out.append((first, last, n))
    return out


def _spells_of(quiet_us: int):
    """Errors of a batch as spells, so that a storm of errors reaches its step as a few rows per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ordered = batch.sort_values(["key", "us"], kind="stable")
            new = (ordered["key"] != ordered["key"].shift()) | (ordered["us"].diff() >= quiet_us)
            spells = ordered.groupby(np.cumsum(new.to_numpy()), sort=False)
            yield pd.DataFrame({"key": spells["key"].first(), "first_us": spells["us"].min(), "last_us": spells["us"].max(), "n": spells.size()})

    return run


class Watch(StatefulProcessor):
    """The open alert of one step: when its errors began and ended so far, and how many there were.

    The timer stands where the look-back of the last error ends. Errors that come late join the spell they belong to, or
    raise and clear an alert of their own if they are older than the open one.
    """

    def __init__(self, quiet_us: int):
        self.quiet_us = quiet_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", SPELL)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came = [tuple(map(int, r)) for batch in rows for r in batch[["first_us", "last_us", "n"]].itertuples(index=False)]
        known = self.open.get() if self.open.exists() else None
        spells = joined_spells([*([tuple(map(int, known))] if known else []), *came], self.quiet_us)
        out = []
        for spell in spells:
            first, last, n = spell
            if not (known and first <= known[0] and known[1] <= last):  # the open alert was raised before
                out.append((key[0], RAISED, first, first, last, n))
            if spell is not spells[-1]:
                out.append(self._cleared(key, spell))
        self._keep(spells[-1])
        yield self._rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        spell = tuple(map(int, self.open.get()))
        self.open.clear()
        yield self._rows([self._cleared(key, spell)])

    def close(self) -> None:
        pass

    def _keep(self, spell: tuple[int, int, int]) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.open.update(spell)
        # A timer fires once time has reached it; it counts in milliseconds, rounded up.
        self.handle.registerTimer(-(-(spell[1] + self.quiet_us) // 1000))

    def _cleared(self, key, spell: tuple[int, int, int]) -> tuple:
        first, last, n = spell
        return key[0], CLEARED, last + self.quiet_us, first, last, n

    @staticmethod
    def _rows(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=[c.split()[0] for c in ALERTS.split(", ")])


def step_alerts(log: DataFrame, by: str = "step_name", minutes: int = 5, late: str = "10 minutes") -> DataFrame:
    """Alerts per step over a stream of the log: (``by``, event, at, first_error, last_error, error_count).

    An error raises an alert in the very trigger that reads it, unless the step has an open one: errors less than
    ``minutes`` after the last one only prolong it. When time has moved on for that long without an error, the alert is
    cleared, with the number of its errors. Time is that of the log, moved by all events, not only by errors, and less
    ``late``. Rows without a step count as one step, rows without a time are no errors.
    """
    quiet_us = minutes * 60_000_000
    timed = _timed(log, late)
    # The condition names the event time, so it stays above the watermark and healthy events move time, too.
    errors = timed.where(F.when(F.col("log_level") == "ERROR", F.col("event_time")).isNotNull())
    micros = errors.select(F.col(by).cast("string").alias("key"), F.unix_micros("event_time").alias("us"))
    spells = micros.mapInPandas(_spells_of(quiet_us), f"key string, {SPELL}")
    found = spells.groupBy("key").transformWithStateInPandas(Watch(quiet_us), ALERTS, "Append", "EventTime")
    times = {"at": "at_us", "first_error": "first_us", "last_error": "last_us"}
    return found.select(
        F.col("key").alias(by),
        "event",
        *[F.timestamp_micros(us).cast("timestamp_ntz").alias(name) for name, us in times.items()],
        "error_count",
    )


def start_alerts(alerts: DataFrame, target: str, checkpoint: str, every: str | None = "10 seconds") -> StreamingQuery:
    """Append the events of ``step_alerts`` to a table. State lies in RocksDB, which timers need; the setting of the
    session is put back once the query has taken it."""
    conf, key = alerts.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, STATE_STORE)
    try:
        return write_alerts(alerts, target, checkpoint, every)
    finally:
        conf.set(key, before)


def write_alerts(alerts: DataFrame, target: str, checkpoint: str, every: str | None = "5 minutes") -> StreamingQuery:
    """Append closed windows to an alert table; without an interval, process what is there and stop."""
    writer = alerts.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(target)
