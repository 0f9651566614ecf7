"""Calendar windows and date-range generators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIODS = ("day", "week", "month", "season")


def month_window(d: Column | str, months_back: int) -> tuple[Column, Column]:
    """First and last day of the calendar month that lies ``months_back`` months before ``d``."""
    first = F.trunc(F.add_months(d, -months_back), "MM")
    return first, F.last_day(first)


def lookback(d: Column | str, days: int = 120) -> tuple[Column, Column]:
    """First of the month that holds the day ``days`` before this month's first, up to this month's first."""
    end = F.trunc(d, "MM")
    return F.trunc(F.date_sub(end, days), "MM"), end


def season_start(d: Column) -> Column:
    """Seasons start in December, March, June and September."""
    return F.add_months(F.trunc(F.add_months(d, 1), "quarter"), -1)


def date_ranges(bounds: DataFrame, start: str, end: str, period: str = "month") -> DataFrame:
    """Split ``[start, end]`` of each row into whole periods; the first and last are cut at the ends.

    Other columns of ``bounds`` are kept, ``range_start`` and ``range_end`` are added (both inclusive).
    """
    if period not in PERIODS:
        raise ValueError(f"period must be one of {', '.join(PERIODS)}")
    lo, hi = F.col(start), F.col(end)
    if period == "day":
        anchor, step, after = lo, F.make_dt_interval(days=F.lit(1)), lambda x: F.date_add(x, 1)
    elif period == "week":
        anchor, step, after = lo, F.make_dt_interval(days=F.lit(7)), lambda x: F.date_add(x, 7)
    elif period == "month":
        anchor, step, after = F.trunc(lo, "MM"), F.make_ym_interval(months=F.lit(1)), lambda x: F.add_months(x, 1)
    else:
        anchor, step, after = season_start(lo), F.make_ym_interval(months=F.lit(3)), lambda x: F.add_months(x, 3)
    opened = bounds.where(lo <= hi).withColumn("_at", F.explode(F.sequence(anchor, hi, step)))
    return opened.select(
        *bounds.columns,
        F.greatest(F.col("_at"), lo).alias("range_start"),
        F.least(F.date_sub(after(F.col("_at")), 1), hi).alias("range_end"),
    )
