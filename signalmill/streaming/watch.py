"""Counts of streams over all their batches, taken by a listener as the batches end."""

from __future__ import annotations

import threading
import time
from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

BATCH_ROWS = "run_id string, name string, batch_id bigint, input_rows bigint, late_rows bigint, state_rows bigint, watermark string"


@dataclass
class RunCounts:
    """What one run of a stream has done so far. ``observed`` sums up the numbers of ``observe`` by name."""

    name: str | None = None
    batches: int = 0
    input_rows: int = 0
    late_rows: int = 0
    state_rows: int = 0
    watermark: str | None = None
    ended: bool = False
    observed: dict[str, dict[str, int]] = field(default_factory=dict)


class StreamWatch(StreamingQueryListener):
    """Adds up every batch of every stream of a session; unlike a query's own progress, which keeps the last hundred.

    Late rows are those that stateful operators drop behind the watermark. ``KEPT`` batches are held one by one
    until ``take`` hands them over; the counts hold all.
    """

    KEPT = 10_000

    def __init__(self):
        self._lock = threading.Lock()
        self._runs: dict[str, RunCounts] = {}
        self._batches: deque[tuple] = deque(maxlen=self.KEPT)

    def watch(self, spark: SparkSession) -> "StreamWatch":
        spark.streams.addListener(self)
        return self

    def stop(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._runs[str(event.runId)] = RunCounts(event.name)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        late, held = sum(s.numRowsDroppedByWatermark for s in state), sum(s.numRowsTotal for s in state)
        mark = dict(p.eventTime or {}).get("watermark")
        with self._lock:
            run = self._runs.setdefault(str(p.runId), RunCounts(p.name))
            run.batches += 1
            run.input_rows += p.numInputRows
            run.late_rows += late
            run.state_rows = held
            run.watermark = mark or run.watermark
            for name, row in (p.observedMetrics or {}).items():
                sums = run.observed.setdefault(name, {})
                for key, value in row.asDict().items():
                    sums[key] = sums.get(key, 0) + (value or 0)
            self._batches.append((str(p.runId), p.name, p.batchId, p.numInputRows, late, held, mark))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._runs.setdefault(str(event.runId), RunCounts()).ended = True

    def counts(self, query: StreamingQuery, wait: float = 30.0) -> RunCounts:
        """The counts of a query's run. Events come after the batches: of a query that has ended, the last is waited for."""
        until = time.monotonic() + wait
        while True:
            with self._lock:
                run = self._runs.get(str(query.runId))
                if run is not None and (run.ended or query.isActive):
                    return run
            if time.monotonic() > until:
                raise TimeoutError(f"no end of run {query.runId} was reported")
            time.sleep(0.02)

    def take(self, spark: SparkSession) -> DataFrame:
        """The batches since the last call, as rows to append to a table."""
        with self._lock:
            rows = list(self._batches)
            self._batches.clear()
        return spark.createDataFrame(rows, BATCH_ROWS)
