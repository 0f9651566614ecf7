"""File-arrival ingest: take every new file once, merge it into the current table, stop when nothing is left."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loanmart.operators.buckets import BUCKET, exists, hash_bucket, merge_buckets
from loanmart.session import staging

#: Buckets of the current table.
BUCKETS = 32
VERSION = ("arrived", "source_file")


def arriving(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet", glob: str | None = None,
             files_per_batch: int | None = None) -> DataFrame:
    """A stream of the files in a folder, with ``source_file`` and the time it ``arrived``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("arrived"))


def newest(loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the row of the newest file, with its version.

    Files that arrived together are ordered by path, rows of one key in one file by their remaining columns, largest last.
    Rows without a key replace nothing and all stay; equal ones of one file count once.
    """
    no_key = " or ".join(f"`{k}` is null" for k in keys)
    rest = [c for c in loaded.columns if c not in (*keys, *VERSION)]
    best = loaded.where(f"not ({no_key})").groupBy(*keys).agg(F.max(F.struct(*VERSION, *rest)).alias("_row"))
    return best.select(*[c if c in keys else F.col(f"_row.`{c}`") for c in loaded.columns]).unionByName(loaded.where(no_key).distinct())


def merge_batch(target: str, keys: list[str], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Merge a batch into the table of current rows at ``target``, which keeps each row's version.

    Only the buckets with keys of the batch are read and replaced. An older version never replaces a newer one, so a
    batch that is run again after a lost executor or driver, or a load with a new checkpoint, changes nothing.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        with staging(batch.sparkSession):
            merge_buckets(batch, target, hash_bucket(keys, buckets), lambda old, new: newest(old.unionByName(new), keys))

    return store


def load_available(stream: DataFrame, target: str, checkpoint: str, keys: list[str], buckets: int = BUCKETS) -> StreamingQuery:
    """Load all files that are there now, then stop."""
    return (
        stream.writeStream.foreachBatch(merge_batch(target, keys, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_when_arrived(stream: DataFrame, target: str, checkpoint: str, keys: list[str], wait_s: float = 30, poke_s: float = 5,
                      buckets: int = BUCKETS) -> bool:
    """Look for files every ``poke_s`` seconds, load the first batch that has rows, and stop; at the latest after ``wait_s``.

    True if something was loaded. A load that is under way when the time is up is finished.
    """
    loaded: list[int] = []
    store = merge_batch(target, keys, buckets)

    def first(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            store(batch, batch_id)
            loaded.append(batch_id)

    query = (
        stream.writeStream.foreachBatch(first)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{max(1, round(poke_s * 1000))} milliseconds")
        .start()
    )
    end = time.monotonic() + wait_s
    try:
        while query.isActive and not loaded and (time.monotonic() < end or query.status["isTriggerActive"]):
            query.awaitTermination(min(0.2, poke_s))
        while query.isActive and query.status["isTriggerActive"]:  # the batch is being marked as done
            query.awaitTermination(0.1)
        if query.exception():
            raise query.exception()
    finally:
        query.stop()
    return bool(loaded)


def current(spark: SparkSession, target: str) -> DataFrame:
    """The current table, without versions."""
    return spark.read.parquet(target).drop(BUCKET, *VERSION)


def stream_ingest(spark: SparkSession, path: str, schema: str | T.StructType, target: str, checkpoint: str, keys: list[str],
                  glob: str | None = None, files_per_batch: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Load what has arrived and return the current table."""
    stream = arriving(spark, path, schema, glob=glob, files_per_batch=files_per_batch)
    load_available(stream, target, checkpoint, keys, buckets).awaitTermination()
    return current(spark, target) if exists(spark, target) else spark.createDataFrame([], schema)
