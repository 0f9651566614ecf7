"""Incremental loads: high-water marks, backfill of missing keys, de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.functions.scalars import number_from_text


def high_watermark(target: DataFrame, key: str) -> DataFrame:
    """Largest key as a number, one row; null for an empty table. Text keys compare as numbers."""
    return target.agg(F.max(number_from_text(F.col(key))).alias("high"))


def footer_max(spark: SparkSession, path: str, key: str) -> int | None:
    """Largest value of a numeric key of Parquet files, taken from their footers; null for no rows.

    A session of its own reads the files by the reader that answers such aggregates from footers, so the caller's
    settings stay. No row is read; one number comes back.
    """
    return footer_mark(spark, path, key).first()["high"]


def footer_mark(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The aggregate behind :func:`footer_max`, one row ``high``, in a session of its own."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = own.read.parquet(path)
    if not isinstance(table.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{key} is no whole number; use high_watermark")
    return table.agg(F.max(key).alias("high"))


def incremental_files(source: DataFrame, path: str, key: str) -> DataFrame:
    """Source rows above the largest key of a Parquet table, which is not scanned; all of them when it has no rows."""
    high = footer_max(source.sparkSession, path, key)
    return source if high is None else source.where(F.col(key) > F.lit(high))


def incremental(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows above the target's largest key; all of them when the target is empty.

    The mark is a scalar subquery, so nothing is collected by hand and the filter still reaches the scan where the key
    is a number; text keys compare as numbers.
    """
    high = high_watermark(target, key).scalar()
    text = isinstance(source.schema[key].dataType, T.StringType)
    return source.where((number_from_text(F.col(key)) if text else F.col(key)) > F.coalesce(high, F.lit(-(2**63))))


def between_keys(source: DataFrame, key: str, above: int, upto: int | None = None) -> DataFrame:
    """Half-open key range ``(above, upto]``."""
    rows = source.where(F.col(key) > above)
    return rows if upto is None else rows.where(F.col(key) <= upto)


def backfill(parent: DataFrame, child: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """Distinct parent keys that the child table lacks."""
    wanted = parent if where is None else parent.where(where)
    return wanted.select(key).distinct().join(child.select(key).distinct(), key, "left_anti")


def only_keys(source: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is in another table (an IN list of any size)."""
    return source.join(keys.select(key).distinct(), key, "left_semi")


def without_keys(source: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is not in another table."""
    return source.join(keys.select(key).distinct(), key, "left_anti")


def once_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """One whole row per key: the one that sorts first by ``order`` and then by all other columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    return df.groupBy(*keys).agg(F.min(row).alias("_row")).select(*keys, "_row.*").select(*df.columns)
