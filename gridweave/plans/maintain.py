"""Keeping a table current: what has settled, what is preliminary, what must be fetched again."""

from __future__ import annotations

import time
import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTLED_DAYS = 6
ARCHIVE_DAYS = 60
REFETCH_DAYS = 2
COMPLETE_HOUR = 17
DUE_DAYS = 7
GAP_MINUTES = 45


def settled(df: DataFrame, today: Column, lag: int = SETTLED_DAYS, day: str = "day") -> DataFrame:
    """Rows up to today less the lag."""
    return df.where(F.col(day) <= F.date_sub(today, lag))


def plan(first: date | None, last: date | None, today: date, lag: int = SETTLED_DAYS) -> dict:
    """What an update would do: the days to add, and whether the table is current."""
    end = today - timedelta(lag)
    start = last + timedelta(1) if last else first
    return {"first": first, "last": last, "start": start, "end": end, "current": start is None or start > end, "days": 0 if start is None or start > end else (end - start).days + 1}


def split_feed(archive: DataFrame, recent: DataFrame, today: Column, days: int = ARCHIVE_DAYS, day: str = "day") -> DataFrame:
    """The archive up to the cut, the recent feed after it."""
    cut = F.date_sub(today, days)
    return archive.where(F.col(day) <= cut).withColumn("feed", F.lit("archive")).unionByName(recent.where(F.col(day) > cut).withColumn("feed", F.lit("recent")))


def usable_day(now: Column, hour: int = COMPLETE_HOUR) -> Column:
    """The last complete day: today from the hour on, else yesterday."""
    return F.when(F.hour(now) >= hour, F.to_date(now)).otherwise(F.date_sub(F.to_date(now), 1))


def band(last_settled: Column, usable: Column) -> Column:
    """Days between the settled table and the usable day."""
    return F.when(usable > last_settled, F.sequence(F.date_add(last_settled, 1), usable)).otherwise(F.array().cast("array<date>"))


def fetched_again(day: Column, newest: Column, cached: Column, days: int = REFETCH_DAYS) -> Column:
    """Whether a band day is fetched: not cached, or among the newest, which late data may change."""
    return ~cached | (F.datediff(newest, day) < days)


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with new's rows in place of those with their keys."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def missing_days(want: DataFrame, have: DataFrame, day: str = "day") -> DataFrame:
    return want.select(day).distinct().join(have.select(day).distinct(), day, "left_anti")


def both_feeds(a: DataFrame, b: DataFrame, day: str = "day") -> DataFrame:
    return a.select(day).intersect(b.select(day))


def virtual(history: DataFrame, new: DataFrame, carried: list[str]) -> DataFrame:
    """History and new days as one axis; slow feeds that new days lack are carried on from the last settled row."""
    from ..operators.temporal_join import carried_forward

    out = history.unionByName(new, allowMissingColumns=True)
    return out.withColumns({c: carried_forward(F.col(c)) for c in carried})


def verified(df: DataFrame, event: str, values: list[str], day: str = "day") -> DataFrame:
    """One row: last day, days with an event, share of finite values in all."""
    cells = [F.avg(F.col(v).isNotNull().cast("double")).alias(f"{v}_finite") for v in values]
    return df.agg(F.max(day).alias("last_day"), F.count_distinct(F.when(F.col(event) > 0, F.col(day))).alias("event_days"), *cells)


def due(now_minutes: float, last_run_minutes: float | None, lock_minutes: float | None, gap: float = GAP_MINUTES, stale: float = 180.0) -> bool:
    """Whether a run may start: none runs (or its lock is stale), and the last one ended long enough ago."""
    locked = lock_minutes is not None and now_minutes - lock_minutes < stale
    return not locked and (last_run_minutes is None or now_minutes - last_run_minutes >= gap)


class RunLock:
    """A file in the store that one run holds: made only if it is not there, touched while the run lives.

    A lock that was not touched for ``stale`` minutes belongs to a lost run and is taken over.
    """

    def __init__(self, spark: SparkSession, path: str, stale: float = 180.0) -> None:
        self.at = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.store = self.at.getFileSystem(spark._jsc.hadoopConfiguration())
        self.stale = stale

    def age(self) -> float | None:
        """Minutes since the lock was touched, nothing without one."""
        if not self.store.exists(self.at):
            return None
        return time.time() / 60 - self.store.getFileStatus(self.at).getModificationTime() / 60000

    def claim(self) -> bool:
        """Whether the lock is ours now."""
        age = self.age()
        if age is not None and age >= self.stale:
            # Of callers that all see the stale lock one can rename it; a lock that has been made anew meanwhile is put back.
            gone = self.at.suffix(f".{uuid.uuid4().hex}")
            try:
                if not self.store.rename(self.at, gone):
                    return False
            except Exception:  # another caller was first
                return False
            fresh = time.time() / 60 - self.store.getFileStatus(gone).getModificationTime() / 60000 < self.stale
            if fresh:
                self.store.rename(gone, self.at)
                return False
            self.store.delete(gone, False)
        elif age is not None:
            return False
        # The file system makes the file for one caller only.
        return bool(self.store.createNewFile(self.at))

    def beat(self) -> None:
        """Says that the run still lives."""
        self.store.setTimes(self.at, int(time.time() * 1000), -1)

    def release(self) -> None:
        self.store.delete(self.at, False)
