"""What streaming queries report about themselves: records of their batches, counts observed on the way, and a thread that writes both."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Records are written once a minute.
FLUSH_SECONDS = 60.0
#: Counts that batches report under this name; they are gathered as the batch runs, without a second pass.
OBSERVED = "counts"


def observed(rows: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """rows, whose batches report how often each condition holds, and their rows as `rows`."""
    found = [F.count_if(F.coalesce(condition, F.lit(False))).alias(name) for name, condition in counts.items()]
    return rows.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), *found)


def record_of(progress: dict, session: str) -> dict:
    """The record of a batch: counts, times, offsets and state sizes, never rows."""
    times, states = progress.get("durationMs") or {}, progress.get("stateOperators") or []
    offset = lambda source, end: None if source.get(f"{end}Offset") is None else json.dumps(source[f"{end}Offset"])
    return {
        "session_id": session,
        "query": progress.get("name"),
        "run_id": progress.get("runId"),
        "batch_id": progress.get("batchId"),
        "timestamp": progress.get("timestamp"),
        "num_input_rows": progress.get("numInputRows"),
        "input_rows_per_second": progress.get("inputRowsPerSecond"),
        "processed_rows_per_second": progress.get("processedRowsPerSecond"),
        "trigger_ms": times.get("triggerExecution"),
        "add_batch_ms": times.get("addBatch"),
        "watermark": (progress.get("eventTime") or {}).get("watermark"),
        "sources": [{f"{end}_offset": offset(s, end) for end in ("start", "end", "latest")} for s in progress.get("sources") or []],
        "state_rows": sum(s.get("numRowsTotal") or 0 for s in states),
        "state_bytes": sum(s.get("memoryUsedBytes") or 0 for s in states),
        "state_dropped": sum(s.get("numRowsDroppedByWatermark") or 0 for s in states),
        "observed": (progress.get("observedMetrics") or {}).get(OBSERVED) or {},
    }


class ProgressListener(StreamingQueryListener):
    """Keeps the records of all queries' batches until they are taken. It does nothing else, as Spark's listener bus waits for it."""

    def __init__(self, session: str):
        self.session = session
        self._records: list[dict] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.add(record_of(json.loads(event.progress.json), self.session))

    def add(self, record: dict) -> None:
        with self._lock:
            self._records.append(record)

    def take(self) -> list[dict]:
        """The records since the last call."""
        with self._lock:
            records, self._records = self._records, []
        return records


@dataclass
class Batch:
    """Records that go into one file. The file is named before the first attempt, so an attempt that is repeated replaces what an
    earlier one may have left: no record is doubled."""

    records: list[dict]
    day: str
    name: str = field(default_factory=lambda: f"{uuid.uuid4().hex}.json")


def json_files(spark: SparkSession, path: str) -> Callable[[Batch], None]:
    """A writer of JSON lines under dt=<day>: each batch one small file, which appears at once and whole."""

    def write(batch: Batch) -> None:
        hadoop = spark._jvm.org.apache.hadoop.fs
        last = hadoop.Path(f"{path}/dt={batch.day}/{batch.name}")
        files = last.getFileSystem(spark._jsc.hadoopConfiguration())
        draft = hadoop.Path(f"{path}/dt={batch.day}/_{batch.name}")  # readers skip names that begin so
        out = files.create(draft, True)
        try:
            out.write("".join(json.dumps(r) + "\n" for r in batch.records).encode())
        finally:
            out.close()
        files.delete(last, False)
        if not files.rename(draft, last):
            raise OSError(f"{last} could not be written")

    return write


class ProgressWriter:
    """Writes the listener's records every so many seconds on a thread of its own, so that no stream waits for storage.

    Records that couldn't be written stay and go first the next time, under the same name; a failure never ends the thread.
    `stop` waits for a write under way and writes what is left, unless the sink fails `attempts` times in a row; it returns how
    many records remain unwritten.
    """

    def __init__(self, listener: ProgressListener, write: Callable[[Batch], None], seconds: float = FLUSH_SECONDS, clock: Callable[[], datetime] | None = None):
        self.listener, self.write, self.seconds = listener, write, seconds
        self.clock = clock or (lambda: datetime.now(UTC))
        self.written, self.failures = 0, 0
        self._waiting: list[Batch] = []
        self._turn = threading.Lock()
        self._stopped = threading.Event()
        self._thread = threading.Thread(target=self._run, name="progress-writer", daemon=True)

    def start(self) -> ProgressWriter:
        self._thread.start()
        return self

    def _run(self) -> None:
        while not self._stopped.wait(self.seconds):
            self.flush()

    def flush(self) -> int:
        """Writes what has come; returns how many records that were."""
        with self._turn:
            if records := self.listener.take():
                self._waiting.append(Batch(records, self.clock().strftime("%Y-%m-%d")))
            before = self.written
            while self._waiting:
                try:
                    self.write(self._waiting[0])
                except Exception:  # noqa: BLE001  metrics never stop a stream; the records stay
                    self.failures += 1
                    break
                self.written += len(self._waiting.pop(0).records)
            return self.written - before

    def stop(self, attempts: int = 3) -> int:
        self._stopped.set()
        if self._thread.is_alive():
            self._thread.join()
        failed, _ = 0, self.flush()
        while self._waiting and failed < attempts:
            failed = 0 if self.flush() else failed + 1
        return sum(len(b.records) for b in self._waiting)


class IngestReport:
    """Counts of a query's batches so far and events a second since the last report, from what the batches observed themselves."""

    def __init__(self, query: str, clock: Callable[[], float] = time.monotonic):
        self.query, self.clock = query, clock
        self.totals: dict[str, int] = {}
        self._seen: set[tuple] = set()
        self._last, self._reported = clock(), 0

    def add(self, records: list[dict]) -> IngestReport:
        """Takes records of any queries; a batch that is reported again counts once."""
        for r in records:
            if r["query"] == self.query and (r["run_id"], r["batch_id"]) not in self._seen:
                self._seen.add((r["run_id"], r["batch_id"]))
                for name, n in r["observed"].items():
                    self.totals[name] = self.totals.get(name, 0) + n
        return self

    def report(self) -> dict:
        now, rows = self.clock(), self.totals.get("rows", 0)
        rate = (rows - self._reported) / max(now - self._last, 1e-9)
        self._last, self._reported = now, rows
        return {**self.totals, "events_per_second": round(rate, 2)}
