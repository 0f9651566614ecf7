"""Registry of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, so results compare the same in every client."""

    def shown(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        return c

    return df.select(*[shown(f) for f in df.schema.fields])


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def iso(expr: str) -> str:
    """Oracle side of :func:`plain` for a date."""
    return f"strftime({expr}, '%Y-%m-%d')"


def iso_time(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"
