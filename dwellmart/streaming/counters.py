"""What the streaming jobs count, and streams that stop themselves."""

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

#: Name of the rows that a stream observes.
OBSERVED = "rows_read"
#: Seconds that the last events of a stream may take to arrive.
_PATIENCE = 60


@dataclass(frozen=True)
class BatchCounts:
    """Rows of one micro-batch: read, of different keys among them, and written to the table."""

    batch_id: int
    read: int
    first_copies: int
    inserted: int


class Progress(StreamingQueryListener):
    """The observed rows of each batch of one stream, kept on the driver: one number a batch.

    Events come on a thread of their own and may come after the stream has ended.
    """

    def __init__(self):
        super().__init__()
        self.rows: dict[str, dict[int, int]] = {}
        self.idle: set[str] = set()
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = progress.observedMetrics.get(OBSERVED)
        with self.changed:
            run = self.rows.setdefault(str(progress.runId), {})
            if observed is not None and observed["rows"]:
                run[progress.batchId] = observed["rows"]
            elif not progress.numInputRows:
                self.idle.add(str(progress.runId))
            self.changed.notify_all()

    def onQueryIdle(self, event) -> None:
        with self.changed:
            self.idle.add(str(event.runId))
            self.changed.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait_until(self, run: str, seen: set[str], query: StreamingQuery) -> None:
        """Wait for an event of a run, or for the end of its stream, which may be a failure."""
        with self.changed:
            while run not in seen and query.isActive:
                self.changed.wait(1)

    def batches(self, run: str) -> list[BatchCounts]:
        """Counts of the batches of a run that has ended."""
        with self.changed:
            self.changed.wait_for(lambda: run in self.ended, _PATIENCE)
            found = sorted(self.rows.get(run, {}).items())
        return [BatchCounts(batch_id, rows, rows, rows) for batch_id, rows in found]


def run_counted(
    spark: SparkSession, start: Callable[[], StreamingQuery], until_idle: bool = False
) -> list[BatchCounts]:
    """Run a stream to its end and return what it observed in each batch.

    With ``until_idle`` a stream that would go on for ever is stopped when a trigger has found nothing new.
    """
    progress = Progress()
    spark.streams.addListener(progress)
    try:
        query = start()
        run = str(query.runId)
        if until_idle:
            progress.wait_until(run, progress.idle, query)
            query.stop()
        query.awaitTermination()
        return progress.batches(run)
    finally:
        spark.streams.removeListener(progress)
