"""Day ranges, day filters and the day grid.

Every job computes a whole inclusive range of days in one Spark job with
``event_date`` as a grouping/join key, instead of one statement per day.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    try:
        return dt.date.fromisoformat(str(value))
    except ValueError as exc:
        raise ValueError(f"malformed date {value!r}, expected YYYY-MM-DD") from exc


@dataclass(frozen=True)
class DayRange:
    """Inclusive range of calendar days ``start..end``."""

    start: dt.date
    end: dt.date

    def __post_init__(self) -> None:
        object.__setattr__(self, "start", _as_date(self.start))
        object.__setattr__(self, "end", _as_date(self.end))
        if self.start > self.end:
            raise ValueError(f"start {self.start} is after end {self.end}")

    @classmethod
    def of(cls, start: dt.date | str, end: dt.date | str | None = None) -> DayRange:
        return cls(start, start if end is None else end)

    @classmethod
    def yesterday(cls, today: dt.date | None = None) -> DayRange:
        """The default scheduled run: the day before ``today``."""
        day = (today or dt.date.today()) - dt.timedelta(days=1)
        return cls(day, day)

    @classmethod
    def covering(cls, df: DataFrame, col: str = "event_date") -> DayRange:
        """Range spanning all days present in ``df[col]`` (one small aggregate)."""
        row = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
        if row is None or row["lo"] is None:
            raise ValueError("cannot derive a day range from an empty table")
        return cls(row["lo"], row["hi"])

    @property
    def n_days(self) -> int:
        return (self.end - self.start).days + 1

    def back_to_start(self) -> DayRange:
        """Every day up to this range's end."""
        return DayRange(dt.date(1000, 1, 1), self.end)

    def halves(self) -> tuple[DayRange, DayRange]:
        """The range's two halves (two days at least)."""
        middle = self.start + dt.timedelta(days=(self.n_days - 1) // 2)
        return DayRange(self.start, middle), DayRange(middle + dt.timedelta(days=1), self.end)

    def days(self) -> list[dt.date]:
        return [self.start + dt.timedelta(days=i) for i in range(self.n_days)]

    def sequence(self) -> Column:
        """Array column holding every day of the range."""
        return F.sequence(F.lit(self.start), F.lit(self.end), F.expr("INTERVAL 1 DAY"))


def within(df: DataFrame, days: DayRange, col: str = "event_date") -> DataFrame:
    """Keep rows whose day falls in ``days``; prunes ``event_date`` partitions.

    A day delivered as ``YYYY-MM-DD`` text is compared as text, so that the range still reaches the
    scan, and becomes a date afterwards.
    """
    if df.schema[col].dataType.typeName() == "string":
        kept = df.where(F.col(col).between(F.lit(days.start.isoformat()), F.lit(days.end.isoformat())))
        return kept.withColumn(col, F.col(col).cast("date"))
    return df.where(F.col(col).between(F.lit(days.start), F.lit(days.end)))


def spread_over_days(df: DataFrame, days: DayRange, col: str = "event_date") -> DataFrame:
    """One copy of every row per day of the range, day column first.

    A generator (``explode``) on each row rather than a join, so the day grid
    is built map-side with no shuffle and no cross join.
    """
    return df.select(F.explode(days.sequence()).alias(col), *df.columns)


def daily_values(dim: DataFrame, counts: DataFrame, days: DayRange, key: str = "prompt_id",
                 col: str = "event_date") -> DataFrame:
    """Every row of ``dim`` on every day with its key's ``counts`` of the day (null without any).

    The counts of a key become one map *day → counts* (at most a day of the range each), the undated
    dimension is joined to them, and the days are exploded after the join: what is shuffled does
    not grow with days × dimension rows.
    """
    names = [c for c in counts.columns if c not in (key, col)]
    by_day = counts.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(col, F.struct(*names)))).alias("by_day"))
    dated = dim.join(by_day, key, "left").select(F.explode(days.sequence()).alias(col), *dim.columns, "by_day")
    value = F.try_element_at("by_day", F.col(col))
    return dated.select(col, *dim.columns, *[value[n].alias(n) for n in names])


def day_spine(spark: SparkSession, days: DayRange, col: str = "event_date") -> DataFrame:
    """One row per day of the range (``days.n_days`` rows)."""
    return spark.range(1).select(F.explode(days.sequence()).alias(col))
