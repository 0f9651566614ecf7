"""Bureau tables: documents to raw-zone tables, incremental by document number."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from loanmart.contracts import CACHE_ID_PATH, ENTITIES, HINT_PATH, Entity
from loanmart.operators.documents import containers, json_path, path_exists, split_container, unnest, unnest_split, unnest_tagged
from loanmart.operators.incremental import backfill, incremental, only_keys
from loanmart.session import settled


def entity(name: str | Entity) -> Entity:
    return name if isinstance(name, Entity) else ENTITIES[name]


def created_between(docs: DataFrame, after: str | dt.datetime | None = None, before: str | dt.datetime | None = None,
                    column: str = "created") -> DataFrame:
    """Documents created after and before given times; both bounds act and both are exclusive."""
    if after is not None:
        docs = docs.where(F.col(column) > F.lit(after).cast("timestamp"))
    if before is not None:
        docs = docs.where(F.col(column) < F.lit(before).cast("timestamp"))
    return docs


def bureau_table(docs: DataFrame, name: str | Entity, path: str | None = None) -> DataFrame:
    """All rows of one bureau table."""
    return unnest(docs, entity(name), path)


def bureau_split(docs: DataFrame, name: str | Entity, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows and rejects of one bureau table."""
    return unnest_split(docs, entity(name), path)


def bureau_tagged(docs: DataFrame, name: str | Entity, path: str | None = None) -> DataFrame:
    """Rows and rejects of one bureau table in one pass: ``reason`` (null for rows), ``raw``, ``key``, ``row``."""
    return unnest_tagged(docs, entity(name), path)


def load_tagged(docs: DataFrame, name: str | Entity, path: str) -> dict[str, int]:
    """Write rows and rejects of one bureau table with one pass, and count both on the way.

    The folder has a partition for each ``kind``: ``row`` and ``reject``; it is replaced. Every element that was read is in
    one of them.
    """
    seen = Observation(f"bureau-{entity(name).name}")
    kind = F.when(F.col("reason").isNull(), "row").otherwise("reject")
    counts = [F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in ("row", "reject")]
    tagged = bureau_tagged(docs, name).withColumn("kind", kind).observe(seen, *counts)
    tagged.write.mode("overwrite").partitionBy("kind").parquet(path)
    return seen.get


def bureau_tables(docs: DataFrame, *names: str | Entity) -> dict[str, DataFrame]:
    """Rows of several bureau tables with one pass over the documents; see :func:`bureau_tables_split`."""
    return {name: rows for name, (rows, _) in bureau_tables_split(docs, *names).items()}


def bureau_tables_split(docs: DataFrame, *names: str | Entity) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Rows and rejects of several bureau tables with one pass over the documents.

    The raw children are written column by column; each table then reads its own column only.
    """
    wanted = [entity(n) for n in names]
    opened = settled(containers(docs, wanted), "bureau")
    return {e.name: split_container(opened, e) for e in wanted}


def new_rows(docs: DataFrame, loaded: DataFrame, name: str | Entity) -> DataFrame:
    """Rows of documents above the loaded table's largest number."""
    return bureau_table(incremental(docs, loaded, "number"), name)


def missing_rows(docs: DataFrame, overview: DataFrame, loaded: DataFrame, name: str | Entity,
                 count_column: str) -> DataFrame:
    """Rows of documents that the overview counts for this table but the table lacks."""
    wanted = backfill(overview, loaded, "number", F.col(count_column) != "0")
    return bureau_table(only_keys(docs, wanted, "number"), name)


def id_map(docs: DataFrame, above: int | None = None) -> DataFrame:
    rows = docs.select(F.col("_id").cast("string").alias("_id"), "number")
    return rows if above is None else rows.where(F.col("number") > above)


def hints(docs: DataFrame, after: str | None = None) -> DataFrame:
    """Hint text per document that has a bureau result; the hint itself may be missing."""
    rows = created_between(docs, after).where(path_exists("doc", HINT_PATH.rsplit(".", 1)[0]))
    return rows.select("number", json_path("doc", HINT_PATH).alias("hint"))


def cache_ids(docs: DataFrame) -> DataFrame:
    """Document number and cached report id, where both are present."""
    rows = docs.select("number", json_path("doc", CACHE_ID_PATH).alias("katm_cache_id"))
    return rows.where(F.col("number").isNotNull() & F.col("katm_cache_id").isNotNull())
