"""Ranks, first rows and running totals that hold up when one key has a large part of all rows.

A window sends all rows of a key to one task. The functions here aggregate first (partial aggregation runs before the
shuffle), so what is left per key is bounded by distinct days or by ``k``, or is dealt by range of values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmart.session import settled


def first_per_group(df: DataFrame, keys: Sequence[str], descending: Sequence[str], pick: str) -> DataFrame:
    """The ``pick`` value of the first row per key, sorted by the ``descending`` columns with nulls last.

    ``pick`` is a number; ties go to the smallest one. Rows with a null key are left out.
    """
    place = F.struct(*[F.col(c) for c in descending], (-F.col(pick)).alias("_pick"))
    keyed = df.where(" and ".join(f"`{k}` is not null" for k in keys))
    best = keyed.groupBy(*keys).agg(F.max(place).alias("_best"))
    return best.select(*keys, (-F.col("_best._pick")).alias(pick))


def smallest_distinct(df: DataFrame, keys: Sequence[str], value: str, k: int, *aggs: Column) -> DataFrame:
    """Per key the ``k`` smallest distinct non-null values as ``rank`` 1..k, with aggregates over each value's rows.

    Distinct values are found first; the rank filter is then pushed below the shuffle by Spark (a group limit), so at
    most ``k`` rows per key and partition travel.
    """
    distinct = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(*(aggs or [F.count("*").alias("n")]))
    w = Window.partitionBy(*keys).orderBy(F.col(value).asc())
    return distinct.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def running_total(df: DataFrame, keys: Sequence[str], day: str, amount: str, out: str, scale: int = 1) -> DataFrame:
    """Running sum per key over days, rows of one day sharing the total, one output row per (key, day).

    The window runs over at most one row per key and day.
    """
    daily = df.groupBy(*keys, day).agg(F.sum(amount).alias("_day"))
    w = Window.partitionBy(*keys).orderBy(F.col(day).asc_nulls_last())
    total = F.sum("_day").over(w)
    return daily.select(*keys, day, (total if scale == 1 else total / F.lit(scale)).alias(out))


def dense_ranks(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank") -> DataFrame:
    """Dense rank of every distinct value per key, ascending with nulls last; one output row per (key, value).

    Distinct pairs are dealt by range of key and value, so the number of ranges follows the session's partitions and a
    key with most pairs lies in most of them. Ranks are counted inside each (key, range) and shifted by the number of
    values in the ranges before. The dealt pairs are written once, as ranges are sampled anew when a plan runs twice.
    """
    place = [*[F.col(k) for k in keys], F.col(value).asc_nulls_last()]
    dealt = df.select(*keys, value).distinct().repartitionByRange(*place)
    cut = settled(dealt.withColumn("_range", F.spark_partition_id()), "dense-ranks")
    sizes = cut.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    below = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(*keys, "_range", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*keys, "_range").orderBy(F.col(value).asc_nulls_last())
    ranked = cut.withColumn("_r", F.row_number().over(inside))
    same = [ranked[k].eqNullSafe(shift[k]) for k in [*keys, "_range"]]
    joined = ranked.join(shift, same, "inner")
    return joined.select(
        *[ranked[k] for k in keys], ranked[value], (F.col("_r") + F.col("_shift")).cast("int").alias(out)
    )
