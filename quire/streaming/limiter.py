"""The request quota as a stateful stream: one state for each key, kept across batches and restarts."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quire.operators.quota import PACIFIC, Limiter


class QuotaProcessor(StatefulProcessor):
    """Admits requests of a key in time order within each batch; state: last request, day and its count."""

    def __init__(self, per_day: int, interval: float, key: str, ts: str, zone: str = PACIFIC) -> None:
        self.per_day, self.interval, self.key, self.ts, self.zone = per_day, interval, key, ts, zone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("quota", "last double, day string, used int")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        last, day, used = self.state.get() if self.state.exists() else (None, None, 0)
        limiter = Limiter(self.per_day, self.interval, self.zone, last, day, used)
        frame = pd.concat(list(rows), ignore_index=True).sort_values(self.ts, kind="stable")
        seconds = frame[self.ts].astype("datetime64[us]").astype("int64") / 1e6
        yield frame.assign(admitted=[limiter.take(at) for at in seconds])
        if limiter.last is not None:
            self.state.update((limiter.last, limiter.day, limiter.used))

    def close(self) -> None:
        pass


def admit_stream(requests: DataFrame, per_day: int, interval: float, *, key: str = "key", ts: str = "ts", zone: str = PACIFIC) -> DataFrame:
    """The streaming form of ``quota.admit``: input columns and ``admitted``."""
    from pyspark.sql import functions as F

    schema = requests.withColumn("admitted", F.lit(True)).schema
    return requests.groupBy(key).transformWithStateInPandas(QuotaProcessor(per_day, interval, key, ts, zone), schema, "Append", "None")
