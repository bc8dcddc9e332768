"""A journal of small events: a file per event group, one file per day once the day is over; and what streaming queries do."""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from wardflow.sources import files

TRIGGERS = "pace string, state string, batch_id bigint, input_rows bigint, at_us bigint, duration_ms bigint, message string"
WORKED, EMPTY, FAILED, STOPPED = "WORKED", "EMPTY", "FAILED", "STOPPED"


def micros(at: dt.datetime) -> int:
    return (at - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)) // dt.timedelta(microseconds=1)


class Journal:
    """Rows as JSON lines below a folder. Writing needs no Spark job; a file is there as a whole or not at all."""

    def __init__(self, spark: SparkSession, folder: str, schema: str | T.StructType):
        self.spark, self.folder, self.schema = spark, folder, schema
        self._swept: str | None = None
        self._lock = threading.Lock()

    def add(self, rows: list[dict]) -> None:
        now = dt.datetime.now(dt.UTC)
        text = "".join(json.dumps(r, sort_keys=True) + "\n" for r in rows)
        files.write_text(self.spark, f"{self.folder}/{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}.json", text)
        self.sweep(now)

    def sweep(self, now: dt.datetime | None = None) -> None:
        """Put the rows of every day that is over into one file. The small files go after that one is there, so a row may
        for a moment, or after a crash, stand in both; readers count it once."""
        today = f"{now or dt.datetime.now(dt.UTC):%Y%m%d}"
        with self._lock:
            if self._swept == today:
                return
            days: dict[str, list[str]] = {}
            for name in files.names(self.spark, self.folder):
                if name[8:9] == "T" and name[:8] < today:
                    days.setdefault(name[:8], []).append(name)
            for day, small in days.items():
                whole = f"{self.folder}/{day}.json"
                parts = [whole] * files.exists(self.spark, whole) + [f"{self.folder}/{n}" for n in small]
                lines = {line for p in parts for line in files.read_text(self.spark, p).splitlines()}
                files.write_text(self.spark, whole, "".join(line + "\n" for line in sorted(lines)))
                for name in small:
                    files.delete(self.spark, f"{self.folder}/{name}")
            self._swept = today

    def read(self) -> DataFrame:
        if not files.filled(self.spark, self.folder):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).json(self.folder).distinct()


class TriggerWatch(StreamingQueryListener):
    """Notes every trigger of the queries of one store: what it read, that it had nothing to do, or why it failed."""

    def __init__(self, journal: Journal, prefix: str):
        self.journal, self.prefix = journal, prefix
        self._paces: dict[str, str] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        if event.name and event.name.startswith(self.prefix):
            self._paces[str(event.runId)] = event.name.removeprefix(self.prefix)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.runId) in self._paces:
            at = dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
            self._note(str(p.runId), WORKED if p.numInputRows else EMPTY, at, p.batchId, p.numInputRows, p.durationMs.get("triggerExecution"))

    def onQueryIdle(self, event) -> None:
        if str(event.runId) in self._paces:
            self._note(str(event.runId), EMPTY, dt.datetime.fromisoformat(event.timestamp.replace("Z", "+00:00")))

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        if run not in self._paces:
            return
        message = event.exception.strip().split("\n", 1)[0] if event.exception else None
        self._note(run, FAILED if message else STOPPED, dt.datetime.now(dt.UTC), message=message)
        with self._change:
            self._ended.add(run)
            self._change.notify_all()

    def _note(self, run: str, state: str, at: dt.datetime, batch_id: int | None = None, rows: int = 0, ms: int | None = None, message: str | None = None) -> None:
        row = {"pace": self._paces[run], "state": state, "batch_id": batch_id, "input_rows": rows, "at_us": micros(at), "duration_ms": ms, "message": message}
        self.journal.add([row])

    def wait_for(self, run: str, seconds: float = 20) -> None:
        """Events come a little later than what they tell of."""
        with self._change:
            self._change.wait_for(lambda: run in self._ended, seconds)


def shown(triggers: DataFrame) -> DataFrame:
    at = F.timestamp_micros("at_us").cast("timestamp_ntz").alias("at")
    return triggers.select("pace", "state", "batch_id", "input_rows", at, "duration_ms", "message")
