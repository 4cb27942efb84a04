"""Lag alarms over a stream of samples, with run lengths held per consumer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidelog.operators.lag import ABNORMAL, REPEAT_PERIOD, elapsed_text, status_text

SILENT = "SILENT"


class StatusRuns(StatefulProcessor):
    """State of a consumer: its last sample, that sample's status and run, and how long it has been silent."""

    def __init__(self, consumer: StructField, max_gap: int | None, period: int, silence: float | None):
        self.max_gap, self.period, self.silence = max_gap, period, silence
        self.schema = StructType([StructField("sample_no", LongType()), StructField("status", StringType()),
                                  StructField("run", LongType()), StructField("silent", LongType())])
        self.output = StructType([consumer, StructField("sample_no", LongType()), StructField("status", StringType()),
                                  StructField("run", LongType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.schema)

    def _frame(self, key, numbers, statuses, runs) -> pd.DataFrame:
        consumer, *rest = self.output.fieldNames()
        columns = [numbers, statuses, runs]
        return pd.DataFrame({consumer: pd.Series([key[0]] * len(runs), dtype=object), **dict(zip(rest, columns))})

    def _watch(self, timers) -> None:
        if self.silence is not None:
            for due in list(self.handle.listTimers()):
                self.handle.deleteTimer(due)
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + max(1, round(1000 * self.silence)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat([f[["sample_no", "status"]] for f in rows]).sort_values("sample_no")
        known = self.last.get() if self.last.exists() else None
        if known:
            frame = frame[frame["sample_no"] > known[0]]
        # a sample delivered twice counts once
        frame = frame.drop_duplicates("sample_no")
        if not len(frame):
            return
        numbers = frame["sample_no"].to_numpy().astype(np.int64)
        statuses = np.array([s if isinstance(s, str) else None for s in frame["status"]], dtype=object)
        before_no = np.concatenate([[known[0] if known else numbers[0]], numbers[:-1]])
        before = np.concatenate([np.array([known[1] if known else statuses[0]], dtype=object), statuses[:-1]])
        change = statuses != before
        if self.max_gap is not None:
            change |= numbers - before_no > self.max_gap
        place = np.arange(len(numbers))
        start = np.maximum.accumulate(np.where(change, place, -(known[2] if known else 0)))
        run = place - start + 1
        self.last.update((int(numbers[-1]), statuses[-1], int(run[-1]), 0))
        self._watch(timerValues)
        due = np.isin(statuses.astype(str), ABNORMAL) & ((run == 1) | (run % self.period == 0))
        if due.any():
            yield self._frame(key, numbers[due], statuses[due], run[due])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.last.exists():
            return
        number, status, run, silent = self.last.get()
        silent += 1
        self.last.update((number, status, run, silent))
        self._watch(timerValues)
        if silent == 1 or silent % self.period == 0:
            yield self._frame(key, [number], [SILENT], [silent])

    def close(self) -> None:
        pass


def stream_lag_alerts(samples: DataFrame, max_gap: int | None = None, period: int = REPEAT_PERIOD,
                      silence: float | None = None) -> DataFrame:
    """``lag_alerts`` over a stream: the first sample of an abnormal run and every ``period``-th after it.

    Runs go on across batches and restarts. Samples of a consumer have to come in the order of
    their numbers from batch to batch (within one in any); one that comes later than a higher
    number, or again, is passed over. With ``silence`` a consumer without a new sample for so
    many seconds raises an alarm with status ``SILENT``, repeated at every ``period``-th such
    span. Rows without consumer or number are left out. Needs the RocksDB state store provider.
    """
    known = (samples.select("consumer", F.col("sample_no").cast("bigint").alias("sample_no"), "status")
             .filter(F.col("consumer").isNotNull() & F.col("sample_no").isNotNull()))
    runs = StatusRuns(known.schema["consumer"], max_gap, period, silence)
    alerts = known.groupBy("consumer").transformWithStateInPandas(
        statefulProcessor=runs, outputStructType=runs.output, outputMode="Update",
        timeMode="None" if silence is None else "ProcessingTime")
    return alerts.withColumns({"status_text": status_text(F.col("status")), "elapsed": elapsed_text(F.col("run"))})
