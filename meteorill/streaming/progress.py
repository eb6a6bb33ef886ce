"""What came in with each micro-batch and how long it took, kept by a listener.

The records are counted by the stream's own plan while a batch runs; no batch is read again for it.
"""

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from meteorill.schemas import PROGRESS
from meteorill.sources.tables import write_progress

#: Name of the metric that counts a stream's records.
METRIC = "records"


def counted(records: DataFrame) -> DataFrame:
    """`records`, counted while they pass."""
    return records.observe(METRIC, F.count(F.lit(1)).alias("input_rows"))


class ProgressLog(StreamingQueryListener):
    """Writes a row for every batch of the queries that it follows, batches without records included.

    Rows are written `every` so many batches and when a query ends, by the listener's thread, so that the
    stream does not wait. A driver that dies loses the rows not written yet, and nothing else; a batch
    that runs again replaces its row.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20) -> None:
        self.spark, self.path, self.every = spark, path, every
        self.lock = threading.Lock()
        self.streams: dict[str, str] = {}
        self.rows: dict[str, list[tuple]] = {}
        self.ended: set[str] = set()
        self.written: dict[str, threading.Event] = {}

    def follow(self, query: StreamingQuery, stream: str) -> None:
        """Rows of `query` are kept from its start on, also where it has made batches, or ended, before this call."""
        run = str(query.runId)
        with self.lock:
            self.streams[run] = stream
            self.written.setdefault(run, threading.Event())
            ended = run in self.ended
        if ended:
            self._write(run, last=True)

    def onQueryStarted(self, event) -> None:
        """Nothing yet."""

    def onQueryProgress(self, event) -> None:
        progress, run = event.progress, str(event.progress.runId)
        observed = progress.observedMetrics.get(METRIC)
        row = (progress.batchId, observed["input_rows"] if observed else 0, progress.durationMs.get("triggerExecution"))
        with self.lock:
            kept = self.rows.setdefault(run, [])
            # A trigger without a batch reports the last one's number again, with nothing in it.
            if not kept or kept[-1][0] != row[0]:
                kept.append(row)
            full = run in self.streams and len(kept) >= self.every
        if full:
            self._write(run)

    def onQueryIdle(self, event) -> None:
        """Nothing came in: no batch."""

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        with self.lock:
            self.ended.add(run)
        self._write(run, last=True)

    def _write(self, run: str, last: bool = False) -> None:
        with self.lock:
            if (stream := self.streams.get(run)) is None:
                return
            rows = self.rows.pop(run, [])
        if rows:
            write_progress(self.spark.createDataFrame([(stream, *row) for row in rows], PROGRESS), self.path)
        if last:
            self.written[run].set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all rows of a query that has ended are written."""
        if not self.written[str(query.runId)].wait(seconds):
            raise TimeoutError(f"the end of query {query.runId} was not reported within {seconds} s")


def follow(spark: SparkSession, path: str) -> ProgressLog:
    """A log that has been added to the session's listeners; `spark.streams.removeListener` ends it."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    return log
