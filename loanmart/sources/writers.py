"""Sinks and write modes. Writes are safe to repeat unless they append by nature.

Replacing a plain path deletes before it writes; a job that must never leave a gap writes to a new place instead.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.contracts import raw_schema
from loanmart.operators.documents import conform
from loanmart.session import remove_dir, settle
from loanmart.sources.readers import valid_identifier


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append typed rows; the table appears with the first write."""
    df.write.mode("append").format(fmt).save(path)


def append_raw(df: DataFrame, path: str, columns: Sequence[str], essential: Sequence[str] = ()) -> None:
    """Append to a raw-zone table in the shape of its contract."""
    conform(df, columns, essential).write.mode("append").parquet(path)


def append_table(df: DataFrame, name: str) -> None:
    """Append to a table that must exist, matching columns by name."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(valid_identifier(name)):
        raise ValueError(f"table {name} does not exist")
    df.select(*spark.read.table(name).columns).write.mode("append").insertInto(name)


def create_table(spark: SparkSession, name: str, columns: Sequence[str] | T.StructType, path: str | None = None,
                 replace: bool = False) -> None:
    """Create a table from a contract, only when absent; ``replace`` drops it first."""
    schema = columns if isinstance(columns, T.StructType) else raw_schema(columns)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    name = valid_identifier(name)
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{place}")


def truncate(spark: SparkSession, name: str) -> None:
    """Remove all rows, keep the table (also an external one)."""
    schema = spark.read.table(valid_identifier(name)).schema
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")  # a dynamic overwrite by no rows would replace no partition
    try:
        spark.createDataFrame([], schema).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(key, before)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``; running it again gives the same table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def with_run_date(df: DataFrame, run_date: str, column: str = "date_modified") -> DataFrame:
    return df.withColumn(column, F.lit(run_date).cast("date"))


def backup(df: DataFrame, path: str, run_date: str, column: str = "date_modified") -> None:
    """Add a dated snapshot of a table. One partition per run date, so a repeated run replaces its own snapshot."""
    replace_partitions(with_run_date(df, run_date, column), path, [column])


def full_reload(current: DataFrame | None, fresh: DataFrame, path: str, backup_path: str, run_date: str) -> None:
    """Back up the loaded table, then replace it. ``fresh`` must not read from ``path``."""
    if current is not None:
        backup(current, backup_path, run_date)
    overwrite(fresh, path)


def csv_per_partition(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    df.write.mode("overwrite").option("header", True).partitionBy(*partition_by).csv(path)


def dated_export(df: DataFrame, path: str, ds: str) -> None:
    """Header CSV under a dated folder, replaced when run again."""
    df.write.mode("overwrite").option("header", True).csv(f"{path.rstrip('/')}/ds={ds}")


def json_lines(df: DataFrame, path: str) -> None:
    """UTF-8 JSON lines; non-ASCII text stays readable."""
    df.write.mode("overwrite").json(path)


def jdbc_options(connection: Mapping[str, str], table: str, batchsize: int = 1000) -> dict[str, str]:
    """Writer options. Text columns get the dialect's unbounded text type, so no raw value is too long."""
    return {**connection, "dbtable": table, "batchsize": str(batchsize)}


def write_jdbc(df: DataFrame, connection: Mapping[str, str], table: str, mode: str = "append", batchsize: int = 1000,
               partitions: int | None = None, truncate: bool = False) -> None:
    """JDBC sink. ``partitions`` limits the number of parallel connections to the database."""
    # a shuffle, so that the work before keeps its own tasks
    out = df.repartition(partitions) if partitions else df
    options = jdbc_options(connection, table, batchsize)
    if truncate:
        options["truncate"] = "true"
    out.write.format("jdbc").mode(mode).options(**options).save()


def to_many(df: DataFrame, *sinks: Callable[[DataFrame], None]) -> None:
    """Compute once, write to several sinks. The rows wait in the shared folder, where a lost executor takes none along."""
    kept, path = settle(df, "sinks")
    try:
        for sink in sinks:
            sink(kept)
    finally:
        remove_dir(df.sparkSession, path)
