"""A table of what every micro-batch handled, written as the batches end."""

from __future__ import annotations

import threading
from queue import Queue

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from gaugeline.sinks.batches import read_batches, write_batch

PROGRESS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("sink", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("milliseconds", T.LongType()),
    ]
)


class ProgressLog(StreamingQueryListener):
    """One row per batch and observation made by :func:`gaugeline.sinks.progress.counted`.

    ``query`` is the id that a checkpoint keeps over restarts, and a batch is committed once under it, so a
    batch reported again after a restart adds nothing. Rows are written by a thread of their own:
    neither the stream nor the other listeners wait for it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.waiting: Queue = Queue()
        self.ended: dict[str, threading.Event] = {}
        threading.Thread(target=self._write, daemon=True).start()
        spark.streams.addListener(self)

    def _end_of(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = event.progress
        counts = {name: row["rows"] for name, row in told.observedMetrics.items()}
        took = told.durationMs.get("triggerExecution", 0)
        self.waiting.put((str(told.id), told.batchId, counts, took))

    def onQueryTerminated(self, event) -> None:
        self.waiting.put(self._end_of(str(event.runId)))

    def _write(self) -> None:
        while (told := self.waiting.get()) is not None:
            if isinstance(told, threading.Event):
                told.set()
                continue
            query, batch_id, counts, took = told
            if counts:
                rows = [(query, sink, batch_id, n, took) for sink, n in sorted(counts.items())]
                write_batch(self.spark.createDataFrame(rows, PROGRESS).coalesce(1), self.path, query, batch_id)

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until all progress of a query that has ended is written."""
        return self._end_of(str(query.runId)).wait(seconds)

    def close(self) -> None:
        self.spark.streams.removeListener(self)
        self.waiting.put(None)


def progress(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path, PROGRESS)
