"""Whether all chunks of a stream's jobs arrive: retries, deadlines and resumed runs.

An extension: a job's chunks come as rows in any order, some fail and come again, some
never do. State is kept per job and lives in the query's checkpoint, so a stopped
query goes on where it ended. The state store must be RocksDB
(spark.sql.streaming.stateStore.providerClass).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT = "job string, event string, chunk int, chunks int, attempts int"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Job(StatefulProcessor):
    """A job's state: the chunks seen with their attempts, and the job's expected number,
    how many are there, and what was said last."""

    def __init__(self, attempts: int, patience_ms: int):
        self.attempts, self.patience = attempts, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "chunk int", "attempts int, ok boolean")
        self.job = handle.getValueState("job", "expected int, there int, said string, timer long")

    def _last(self) -> list:
        return list(self.job.get()) if self.job.exists() else [0, 0, "open", 0]

    def _row(self, key, event: str, chunk: int | None, chunks: int, attempts: int | None) -> Row:
        return Row(job=key[0], event=event, chunk=chunk, chunks=chunks, attempts=attempts)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        expected, there, said, timer = self._last()
        for r in rows:
            expected = max(expected, r.expected or 0)
            if r.chunk is None:
                continue
            tried, ok = self.chunks.getValue((r.chunk,)) if self.chunks.containsKey((r.chunk,)) else (0, False)
            if ok:
                yield self._row(key, "repeated", r.chunk, there, tried)
                continue
            tried += 1
            self.chunks.updateValue((r.chunk,), (tried, bool(r.ok)))
            if r.ok:
                there += 1
                if said == "overdue":
                    yield self._row(key, "late", r.chunk, there, tried)
            else:
                yield self._row(key, "retry" if tried < self.attempts else "given up", r.chunk, there, tried)
            if not timer:
                timer = int(r.time.timestamp() * 1000) + self.patience
                self.handle.registerTimer(timer)
        if expected and there >= expected and said != "complete":
            said = "complete"
            yield self._row(key, said, None, there, None)
            if timer > 0:
                self.handle.deleteTimer(timer)
                timer = -1
        self.job.update((expected, there, said, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        expected, there, said, _ = self._last()
        if said == "open":
            self.job.update((expected, there, "overdue", -1))
            yield self._row(key, "overdue", None, there, None)

    def close(self) -> None:
        pass


def completeness(df: DataFrame, attempts: int = 5, patience_seconds: int = 3600, delay: str = "1 minute") -> DataFrame:
    """job, event, chunk, chunks (there so far), attempts: what happens to a stream's jobs.

    df, a stream: job, chunk, expected (the job's chunks; the largest one told counts), ok,
    time. Events: retry for a chunk that failed, given up when it failed for the attempts-th
    time or later, repeated for one that was there already, complete once all chunks are
    there, overdue once if they aren't when the watermark (delay behind the latest time)
    passes patience_seconds after the job's first chunk, late for a chunk that comes after
    that. Rows without a job are left out; a null chunk only tells the expected number; a
    null ok is a failure. State is a job's chunks; it stays for jobs that are complete, so
    that chunks that come again are told from new ones."""
    rows = df.where("job is not null and time is not null").withWatermark("time", delay)
    return rows.groupBy("job").transformWithState(statefulProcessor=_Job(attempts, patience_seconds * 1000), outputStructType=OUT, outputMode="Append", timeMode="EventTime")
