"""A record of how streams go, and of why they end."""

from __future__ import annotations

import re
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: Errors after which input is gone: a retry gives the same error, or rows are missing.
LOST = re.compile(
    r"SparkFileNotFoundException|FileNotFoundException|FILE_NOT_EXIST|CANNOT_READ_FILE_FOOTER|FAILED_READ_FILE|PATH_NOT_FOUND|not a Parquet file"
    r"|OffsetOutOfRange|data may have been lost|failOnDataLoss|KAFKA_DATA_LOSS|Partition .* offset was changed",
)
#: Errors of the moment: the same run may succeed later.
PASSING = re.compile(
    r"TimeoutException|timed out|ConnectException|Connection (refused|reset)|UnknownHost|BrokerNotAvailable|LeaderNotAvailable|NotLeader"
    r"|ExecutorLostFailure|FetchFailed|SocketException|Service ?Unavailable|SlowDown|TooManyRequests",
    re.IGNORECASE,
)
SCHEMA = "run string, number long, state string, kind string, batch long, rows long, message string"


def classify(error: str | None) -> str:
    """``none``, ``data loss``, ``retryable`` or ``other``. A loss counts before an error of the moment."""
    if not error:
        return "none"
    if LOST.search(error):
        return "data loss"
    return "retryable" if PASSING.search(error) else "other"


class StreamWatch(StreamingQueryListener):
    """Notes starts, progress with rows, and ends of the session's streams, in the order they happen."""

    def __init__(self):
        self.events: list[tuple] = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def _note(self, run, state, kind="none", batch=None, rows=None, message=None) -> None:
        with self._changed:
            self.events.append((str(run), len(self.events), state, kind, batch, rows, message))
            if state == "ended":
                self._ended.add(str(run))
            self._changed.notify_all()

    def onQueryStarted(self, event):
        self._note(event.runId, "started")

    def onQueryProgress(self, event):
        self._note(event.progress.runId, "progress", batch=event.progress.batchId, rows=event.progress.numInputRows)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        error = event.exception
        self._note(event.runId, "ended", classify(error), message=error.split("\n", 1)[0][:500] if error else None)

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the end of a query is noted; listeners hear of it a little later than the query's own thread."""
        limit = time.monotonic() + seconds
        with self._changed:
            while str(query.runId) not in self._ended:
                if not self._changed.wait(max(0.0, limit - time.monotonic())):
                    raise TimeoutError(f"no end of query {query.runId} was noted")

    def record(self, spark: SparkSession) -> DataFrame:
        """One row per event."""
        return spark.createDataFrame(self.events, SCHEMA)

    def store(self, spark: SparkSession, path: str) -> None:
        self.record(spark).write.mode("append").parquet(path)


class StreamFailed(Exception):
    """A stream ended with an error; ``kind`` is what ``classify`` says, ``attempts`` how often it was started."""

    def __init__(self, kind: str, attempts: int, message: str):
        super().__init__(f"{kind} after {attempts} attempts: {message}")
        self.kind, self.attempts = kind, attempts


def run_watched(spark: SparkSession, start, watch: StreamWatch, attempts: int = 3, pause: float = 1.0) -> None:
    """Run a stream to its end, again where the error may pass. ``start()`` starts it and gives the query.

    Lost data and other errors raise at once, since a retry cannot mend them.
    """
    spark.streams.addListener(watch)
    try:
        for attempt in range(1, attempts + 1):
            query = start()
            try:
                query.awaitTermination()
                watch.wait_for(query)
                return
            except Exception as error:  # the query's own error, whatever its class
                text = f"{error}\n{query.exception()}"
                watch.wait_for(query)
                kind = classify(text)
                if kind != "retryable" or attempt == attempts:
                    raise StreamFailed(kind, attempt, text.split("\n", 1)[0]) from error
                time.sleep(pause)
    finally:
        spark.streams.removeListener(watch)
