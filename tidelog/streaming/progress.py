"""Statistics records from the progress events of a streaming query."""

from __future__ import annotations

import datetime
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidelog.streaming.stats import STATS_SCHEMA

ROWS = "rows"


def observed_step(df: DataFrame, number: int, message: str) -> DataFrame:
    """``df`` with its rows counted, in the pass that does the work, as step ``number`` of every batch."""
    return df.observe(f"{number}:{message}", F.count(F.lit(1)).alias(ROWS))


class ProgressRecords(StreamingQueryListener):
    """Collects one entry per observed step and batch of the query named ``query_name``.

    Register it with ``spark.streams.addListener`` before the query starts. The batch function
    has no part in it: Spark reports the counts with the progress of each batch, and a
    batch that is repeated after a failure is reported once, when it ends. ``flush`` may be called
    at any time; entries are few (steps times batches since the last call).
    """

    def __init__(self, query_name: str, app_name: str, case_name: str = ""):
        self.query_name, self.app_name, self.case_name = query_name, app_name, case_name
        self._entries: list[tuple] = []
        self._lock, self._ended, self._run = threading.Lock(), threading.Event(), None

    def onQueryStarted(self, event) -> None:
        if event.name == self.query_name:
            self._run = event.runId
            self._ended.clear()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.query_name:
            return
        at = datetime.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        with self._lock:
            for label, row in progress.observedMetrics.items():
                number, _, message = label.partition(":")
                if number.isdigit():
                    self._entries.append((self.app_name, self.case_name, progress.batchId, int(number), at, message, row[ROWS]))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self._run:
            self._ended.set()

    def wait(self, seconds: float = 60.0) -> None:
        """Until the end of the query has been reported, and with it all its batches."""
        if not self._ended.wait(seconds):
            raise TimeoutError(f"the end of query {self.query_name!r} has not been reported")

    def flush(self, spark: SparkSession) -> DataFrame:
        """Entries since the last call, with the columns of ``BatchStats``."""
        with self._lock:
            entries, self._entries = self._entries, []
        return spark.createDataFrame(sorted(entries, key=lambda e: e[2:4]), STATS_SCHEMA)
