"""Statistics of micro-batch steps, counted in the pass that does the work."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The columns of a statistics record.
STATS_SCHEMA = ("APP_NAME string, CASE_NM string, EPOCH_ID bigint, STEM_NUM int, "
                "ENT_TS timestamp, MSG string, ROW_CNT bigint")
STATS_KEY = ["APP_NAME", "CASE_NM", "EPOCH_ID"]


class BatchStats:
    """Collects one entry per step and batch; a batch has a handful of steps."""

    def __init__(self, app_name: str, case_name: str = "",
                 clock: Callable[[], datetime.datetime] = lambda: datetime.datetime.now(datetime.UTC)):
        self.app_name = app_name
        self.case_name = case_name
        self._clock = clock
        self._steps: list[tuple] = []
        self._epoch: int | None = None
        self._number = 0

    def _next(self, epoch_id: int) -> int:
        self._number = self._number + 1 if epoch_id == self._epoch else 1
        self._epoch = epoch_id
        return self._number

    def append(self, epoch_id: int, message: str) -> None:
        """Note that a step was reached."""
        self._steps.append((epoch_id, self._next(epoch_id), self._clock(), message, None))

    def observe(self, epoch_id: int, message: str, df: DataFrame) -> DataFrame:
        """``df`` with its row count noted by the next action on the result."""
        seen = Observation()
        self._steps.append((epoch_id, self._next(epoch_id), self._clock(), message, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def flush(self, spark: SparkSession) -> DataFrame:
        """Entries so far as a frame, and start anew. Call after the batch's actions."""
        entries = [(self.app_name, self.case_name, epoch, number, at, message,
                    seen.get["rows"] if seen is not None else None)
                   for epoch, number, at, message, seen in self._steps]
        self._steps = []
        return spark.createDataFrame(entries, STATS_SCHEMA)
