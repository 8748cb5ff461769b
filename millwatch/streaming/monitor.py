"""Progress of running streams as rows."""

from __future__ import annotations

import json
import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = ("name string, run_id string, batch_id bigint, timestamp string, input_rows bigint, "
            "input_rate double, processed_rate double, duration_ms bigint, watermark string")
COUNTERS = "name string, batch_id bigint, observation string, counter string, value bigint"
TOTALS = "name string, observation string, counter string, total bigint"
OFFSETS = "topic string, partition int, offset bigint, committed bigint"


class ProgressLog(StreamingQueryListener):
    """Keeps the last ``keep`` progress reports of each query run, one small row per micro-batch.

    Totals of counters are kept for as long as the log lives: one number per query, observation and counter.
    """

    def __init__(self, keep: int = 1000):
        self.keep = keep
        self.reports: dict[str, deque[tuple]] = {}
        self.counts: dict[tuple[str, str, str], deque[tuple]] = {}
        self.totals: dict[tuple[str, str, str], int] = {}
        self.offsets: dict[tuple[str, int], tuple[int, int]] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.inputRowsPerSecond,
               p.processedRowsPerSecond, dict(p.durationMs or {}).get("triggerExecution"),
               dict(p.eventTime or {}).get("watermark"))
        with self._lock:
            self.reports.setdefault(str(p.runId), deque(maxlen=self.keep)).append(row)
            for seen, metrics in dict(p.observedMetrics or {}).items():
                for counter, v in metrics.asDict().items():
                    key = (p.name, seen, counter)
                    self.counts.setdefault(key, deque(maxlen=self.keep)).append((p.name, p.batchId, seen, counter, int(v)))
                    self.totals[key] = self.totals.get(key, 0) + int(v)
            for s in p.sources:
                self._note(s)

    def _note(self, source) -> None:
        """Kafka sources report offsets per topic and partition; others do not."""
        try:
            read, latest = json.loads(source.endOffset), json.loads(source.latestOffset)
        except (TypeError, ValueError):
            return
        if not isinstance(latest, dict) or not isinstance(read, dict):
            return
        for topic, parts in latest.items():
            if isinstance(parts, dict):
                for part, end in parts.items():
                    self.offsets[topic, int(part)] = (int(end), int(read.get(topic, {}).get(part, 0)))

    def table(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            return spark.createDataFrame([r for run in self.reports.values() for r in run], PROGRESS)

    def counter_table(self, spark: SparkSession) -> DataFrame:
        """What ``quality.observed`` counted, per micro-batch."""
        with self._lock:
            return spark.createDataFrame([r for kept in self.counts.values() for r in kept], COUNTERS)

    def total_table(self, spark: SparkSession) -> DataFrame:
        """Each counter's sum over all micro-batches the log has seen."""
        with self._lock:
            return spark.createDataFrame([(*key, v) for key, v in self.totals.items()], TOTALS)

    def offset_table(self, spark: SparkSession) -> DataFrame:
        """Ends and read positions, as ``quality.lag`` takes them."""
        with self._lock:
            rows = [(t, p, end, read) for (t, p), (end, read) in self.offsets.items()]
        return spark.createDataFrame(rows, OFFSETS)
