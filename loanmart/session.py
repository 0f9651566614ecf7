"""Session defaults and the shared working folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "loanmart", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster job brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


_FALLBACK: list[str] = []
_STAGED: list[str] = []


def base_dir(setting: str | None, master: str) -> str:
    """The folder for intermediate tables: ``setting``, or in plain local mode a temporary folder of this process.

    Any other master needs the setting, since executors can't read the driver's temporary folder.
    """
    if setting:
        return setting.rstrip("/")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _FALLBACK:
        _FALLBACK.append(tempfile.mkdtemp(prefix="loanmart-"))
    return _FALLBACK[0]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``."""
    base = base_dir(spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.master", "local"))
    return f"{base}/{name}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def settle(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """:func:`settled`, with the folder, for loops that remove the table of the round before."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    _STAGED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from there.

    For results that several later steps read: the work before is done once, a lost executor does not repeat it, and
    later scans read only the columns they need.
    """
    return settle(df, name)[0]


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove, at its end, every intermediate table that was settled inside it.

    Results that read such tables must be written inside the block.
    """
    before = len(_STAGED)
    try:
        yield
    finally:
        for path in _STAGED[before:]:
            remove_dir(spark, path)
        del _STAGED[before:]
