"""Request quotas: calendar days in the quota's time zone, and greedy admission in order."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import plain

PACIFIC = "America/Los_Angeles"
#: HTTP states that are worth another try besides 5xx, and names of transport errors (fixed values).
RETRYABLE = [408, 409, 429]
TRANSPORT = ["ConnectError", "ConnectTimeout", "ReadError", "ReadTimeout", "RemoteProtocolError", "TimeoutError", "ConnectionError"]


def day_window(ts: Column, zone: str = PACIFIC) -> Column:
    """struct(start, end) in UTC of the calendar day that holds ``ts``; DST days have 23 or 25 hours."""
    local = F.date_trunc("day", F.from_utc_timestamp(ts, zone))
    return F.struct(F.to_utc_timestamp(local, zone).alias("start"), F.to_utc_timestamp(local + F.expr("INTERVAL 1 DAY"), zone).alias("end"))


def requests_by_day(events: DataFrame, ts: str = "ts", zone: str = PACIFIC) -> DataFrame:
    day = F.date_format(F.from_utc_timestamp(F.col(ts), zone), "yyyy-MM-dd")
    return events.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))


class Limiter:
    """Admission state: a daily cap by local calendar day and a minimum interval that runs across midnight."""

    def __init__(self, per_day: int, interval: float, zone: str = PACIFIC, last: float | None = None, day: str | None = None, used: int = 0) -> None:
        self.per_day, self.interval, self.zone = per_day, interval, ZoneInfo(zone)
        self.last, self.day, self.used = last, day, used

    def local(self, now: float) -> datetime:
        return datetime.fromtimestamp(now, self.zone)

    def until_reset(self, now: float) -> float:
        midnight = datetime.combine(self.local(now).date() + timedelta(days=1), datetime.min.time(), self.zone)
        return midnight.timestamp() - now

    def wait(self, now: float) -> float:
        """Seconds until a request may go out; 0: now."""
        day = self.local(now).date().isoformat()
        used = self.used if day == self.day else 0
        pause = self.last + self.interval - now if self.interval > 0 and self.last is not None else 0.0
        reset = self.until_reset(now) if 0 < self.per_day <= used else 0.0
        return max(0.0, pause, reset)

    def take(self, now: float) -> bool:
        """Record a request if it may go out."""
        if self.wait(now) > 0:
            return False
        day = self.local(now).date().isoformat()
        self.used = self.used + 1 if day == self.day else 1
        self.day, self.last = day, now
        return True


def admit(requests: DataFrame, per_day: int, interval: float, *, key: str, ts: str = "ts", order: str, zone: str = PACIFIC) -> DataFrame:
    """Add ``admitted`` in time order within each ``key``: a request that must wait is turned away.

    A quota is sequential by nature: rows of a key are sorted by Spark, which spills, and streamed.
    """
    schema = requests.withColumn("admitted", F.lit(True)).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, limiter = object(), None
        for frame in frames:
            seconds = (frame[ts].astype("datetime64[us]").astype("int64") / 1e6).tolist()
            flags = []
            for k, at in zip(frame[key].tolist(), seconds, strict=True):
                if limiter is None or k != now:
                    now, limiter = k, Limiter(per_day, interval, zone)
                flags.append(limiter.take(at))
            yield frame.assign(admitted=flags)

    return requests.repartition(key).sortWithinPartitions(key, ts, order).mapInPandas(run, schema)


def retryable(status: Column, error: Column) -> Column:
    """Whether a failed call is worth another try."""
    return F.coalesce(status.isin(RETRYABLE) | status.between(500, 599), F.lit(False)) | F.coalesce(error.isin(TRANSPORT), F.lit(False))


def daily_quota(snapshot: Column) -> Column:
    """Whether an error says that the day's quota is used up."""
    return F.coalesce(F.lower(snapshot).rlike("per_?day|requestsperday|daily"), F.lit(False))


@F.pandas_udf(T.DoubleType())
def retry_delay(snapshot: pd.Series) -> pd.Series:
    """Seconds that a nested error asks to wait, null if it doesn't say."""
    return snapshot.map(plain.retry_delay, na_action="ignore").astype("float64")


def backoff(attempt: int, most: float = 60.0, jitter: float = 0.0) -> float:
    """Exponential: 1, 2, 4, ... seconds up to ``most``."""
    return min(most, 2.0 ** (attempt - 1) + jitter)


def pause_after_429(snapshot: str, consecutive: int, configured: float, until_reset: float) -> float:
    """A day's quota, or three refusals in a row, wait for the reset; else the longer of both delays."""
    import re

    if consecutive >= 3 or re.search("per_?day|requestsperday|daily", snapshot.lower()):
        return until_reset
    return max(configured, plain.retry_delay(snapshot) or 0.0)
