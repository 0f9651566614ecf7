"""Tables in buckets by key, so that a merge reads and rewrites only what its source touches.

A bucket is a partition folder ``_bucket=n`` of a plain Parquet table. By default a row's bucket is a hash of its keys;
any expression of the keys does (a day, where keys never change it), as long as every call uses the same one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.operators.merge import upsert
from loanmart.session import remove_dir, settled, work_dir

BUCKET = "_bucket"
#: Below a table, where a merge keeps its result until all buckets are replaced; Spark's readers pass over it.
PENDING = "_pending"


def hash_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, mode: str) -> None:
    # a bucket's rows come from one task, or from several if they are many: Spark splits large ones
    out = rows.hint("rebalance", F.col(BUCKET))
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def write_buckets(rows: DataFrame, path: str, bucket: Column) -> None:
    """A new table of buckets."""
    _write(rows.withColumn(BUCKET, bucket), path, "errorifexists")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a merge whose driver was lost while it replaced buckets; true if there was one."""
    pending = f"{path}/{PENDING}"
    whole = exists(spark, f"{pending}/_SUCCESS")
    if whole:
        _write(spark.read.parquet(pending), path, "overwrite")
    if exists(spark, pending):
        remove_dir(spark, pending)
    return whole


def merge_buckets(source: DataFrame, path: str, bucket: Column, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
    """Replace the buckets that ``source`` touches by ``merge(their rows, source)``; returns their numbers.

    The source is written once with its buckets, whose numbers are then few integers; only these buckets are read. The
    merged rows are complete below the table before the first bucket is replaced, and the next merge begins by finishing
    one that was broken off there, so no bucket is lost half-way.
    """
    spark = source.sparkSession
    staged = settled(source.withColumn(BUCKET, bucket), "merge-source")
    touched = sorted(r[0] for r in staged.select(BUCKET).distinct().collect())
    if not touched:
        return []
    fresh = staged.drop(BUCKET)
    if not exists(spark, path):
        _write(merge(fresh.limit(0), fresh).withColumn(BUCKET, bucket), path, "overwrite")
        return touched
    recover(spark, path)
    table = spark.read.schema(staged.schema).parquet(path)
    merged = merge(table.where(F.col(BUCKET).isin(touched)).drop(BUCKET), fresh).withColumn(BUCKET, bucket)
    merged.write.mode("overwrite").parquet(f"{path}/{PENDING}")
    recover(spark, path)
    return touched


def upsert_buckets(source: DataFrame, path: str, keys: Sequence[str], bucket: Column, update_cols: Sequence[str] | None = None) -> list[int]:
    """:func:`loanmart.operators.merge.upsert` into a table of buckets; files of other buckets stay as they are."""
    return merge_buckets(source, path, bucket, lambda target, rows: upsert(target, rows, keys, update_cols))


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


# ---- key tables that join without a shuffle

def write_key_table(rows: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """A catalog table bucketed and sorted by its keys, replaced when there; ``path`` is a new place for its files."""
    place = path or work_dir(rows.sparkSession, "keys")
    rows.write.mode("overwrite").option("path", place).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return rows.sparkSession.read.table(name)


def backfill_bucketed(parent: DataFrame, child: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """Distinct parent keys that the child table lacks, for two key tables bucketed alike: neither side is shuffled."""
    wanted = parent if where is None else parent.where(where)
    return wanted.select(key).distinct().join(child.select(key).hint("merge"), key, "left_anti")


def only_keys_bucketed(source: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is in another table, for two tables bucketed alike by the key: neither side is shuffled."""
    return source.join(keys.select(key).hint("merge"), key, "left_semi")
