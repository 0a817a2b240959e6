"""The running application: all queries of the monitor under one supervisor."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.layers import to_silver
from tidemark.sources.seeds import Reference
from tidemark.streaming import jobs
from tidemark.streaming.progress import FLUSH_SECONDS, ProgressWriter, ProgressListener, json_files

#: State of all queries lives in RocksDB, on disk and off the heap, and checkpoints only what changed.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@dataclass(frozen=True)
class Settings:
    """What is set from outside. `trigger` is that of every query, as of DataStreamWriter.trigger."""

    root: str
    session: str
    trigger: dict
    flush_seconds: float = FLUSH_SECONDS
    drain: bool = True


class QueryFailed(RuntimeError):
    """A query ended with an error; the others were stopped."""

    def __init__(self, name: str, error: str):
        super().__init__(f"{name}: {error}")
        self.query = name


class Application:
    """Five queries over the two topics: raw records, rejected ones, the typed layer, minute windows and alerts.

    Each has a checkpoint of its own for the session, so a start after a stop or a failure goes on where each of them was. `edits` and
    `rejected` make the decoded topics anew for a query. Reference data is looked up once a batch, so rules change without a
    restart and a batch sees one version.
    """

    def __init__(self, spark: SparkSession, settings: Settings, edits: Callable[[], DataFrame], rejected: Callable[[], DataFrame], reference: Callable[[], Reference], stamp: Column | None = None):
        self.spark, self.settings = spark, settings
        self.edits, self.rejected, self.reference = edits, rejected, reference
        self.stamp = F.current_timestamp().cast("timestamp_ntz") if stamp is None else stamp
        self.listener = ProgressListener(settings.session)
        self.writer = ProgressWriter(self.listener, json_files(spark, self.path("progress")), settings.flush_seconds)
        self.running: list = []

    def path(self, table: str) -> str:
        return f"{self.settings.root.rstrip('/')}/{table}"

    def queries(self) -> dict[str, Callable[[], object]]:
        """Each query by its name, as what starts it."""
        own, at = self.settings, self.path
        place = lambda name: {"checkpoint": jobs.checkpoint_path(own.root.rstrip("/"), own.session, name), "trigger": own.trigger}
        return {
            "bronze_edits": lambda: jobs.bronze_stream(self.edits(), own.session, at("bronze"), **place("bronze_edits")),
            "bronze_dlq": lambda: jobs.dlq_stream(self.rejected(), own.session, at("dlq"), **place("bronze_dlq")),
            "silver_edits": lambda: jobs.silver_stream(self.edits(), at("silver"), stamp=self.stamp, **place("silver_edits")),
            "edits_per_min": lambda: jobs.append_to(jobs.edits_per_minute(to_silver(self.edits())), at("edits_per_min"), name="edits_per_min", **place("edits_per_min")),
            "page_alerts": lambda: jobs.alert_stream(self.edits(), self.reference, at("alerts"), stamp=self.stamp, **place("page_alerts")),
        }

    def start(self) -> Application:
        """Starts all queries; if one can't start, those that did are stopped."""
        for name, value in STATE_STORE.items():
            self.spark.conf.set(name, value)
        self.spark.streams.addListener(self.listener)
        self.writer.start()
        try:
            for begin in self.queries().values():
                self.running.append(begin())
        except BaseException:
            self.stop(drain=False)
            raise
        return self

    def wait(self, seconds: float | None = None) -> bool:
        """Waits until all queries have ended by themselves (True) or the time is over (False). If one fails, the others are drained
        and stopped, and QueryFailed names it."""
        left = {q.id: q for q in self.running}
        while left:
            self.spark.streams.resetTerminated()
            gone = [q for q in left.values() if not q.isActive]
            if not gone:
                ended = self._await_any(seconds)
                if ended is False:
                    return False
                gone = [q for q in left.values() if not q.isActive]
            for q in gone:
                left.pop(q.id)
                if q.exception() is not None:
                    self.stop(drain=self.settings.drain)
                    raise QueryFailed(q.name, str(q.exception()).splitlines()[0])
        return True

    def _await_any(self, seconds: float | None) -> bool | None:
        try:
            return self.spark.streams.awaitAnyTermination(seconds) if seconds is not None else self.spark.streams.awaitAnyTermination()
        except Exception:  # noqa: BLE001  the failed query is found by its own exception
            return None

    def stop(self, drain: bool = True) -> int:
        """Ends all queries, after what has come is processed if `drain`; writes the last records. Returns how many couldn't be written."""
        try:
            for q in self.running:
                if drain and q.isActive:
                    try:
                        q.processAllAvailable()
                    except Exception:  # noqa: BLE001  this query fails too: it keeps its checkpoint as any other
                        continue
            for q in self.running:
                q.stop()
            self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        finally:
            self.spark.streams.removeListener(self.listener)
            self.running = []
        return self.writer.stop()

    def run(self) -> None:
        """Start, wait for the end or a failure, stop."""
        self.start()
        self.wait()
        self.stop(drain=False)
