"""Insert-or-update and row-level rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None) -> DataFrame:
    """The target after ``source`` was merged into it.

    Matched rows take ``update_cols`` (default: all non-key columns) from the source, also when the source value is
    null; other source rows are inserted. A null key matches nothing. A key that occurs twice in the source raises an
    error when the result is computed.

    One full outer join gives updated and inserted rows, so both sides are read once.
    """
    keys = list(keys)
    cols = [c for c in target.columns if c not in keys]
    update = cols if update_cols is None else list(update_cols)
    no_key = " or ".join(f"`{k}` is null" for k in keys)

    # rows with a null key stay apart: they are no duplicates of each other
    apart = source.select(*target.columns).withColumn("_apart", F.when(F.expr(no_key), F.monotonically_increasing_id()))
    counted = apart.groupBy(*keys, "_apart").agg(F.count("*").alias("_n"), F.any_value(F.struct(*cols)).alias("_s"))
    once = F.when((F.col("_n") == 1) | F.col("_apart").isNotNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("duplicate source key "), F.to_json(F.struct(*keys)))).cast("boolean")
    )
    src = counted.select(*keys, F.col("_s"), once.alias("_hit"))
    merged = target.select(*keys, F.struct(*cols).alias("_t"), F.lit(True).alias("_old")).join(src, keys, "full_outer")
    old, hit = F.col("_old").isNotNull(), F.coalesce("_hit", F.lit(False))

    def value(c: str) -> Column:
        if c in keys:
            return F.col(f"`{c}`")
        mine, new = F.col(f"_t.`{c}`"), F.col(f"_s.`{c}`")
        return F.when(hit & (~old | F.lit(c in update)), new).otherwise(mine).alias(c)

    return merged.select(*[value(c) for c in target.columns])


def reject_split(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every check, and the others with the names of the checks they fail.

    A check that gives null counts as failed.
    """
    failed = F.array_compact(
        F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(None)).otherwise(F.lit(n)) for n, test in checks.items()])
    )
    marked = df.withColumn("_failed", failed)
    good = marked.where(F.size("_failed") == 0).drop("_failed")
    bad = marked.where(F.size("_failed") > 0).withColumn("reason", F.array_join("_failed", ", ")).drop("_failed")
    return good, bad


def typed(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Cast text columns to their types; rows with a value that does not fit go to the rejects with a reason."""
    checks = {f"{c} is no {t}": F.col(c).isNull() | F.col(c).try_cast(t).isNotNull() for c, t in types.items()}
    good, bad = reject_split(df, checks)
    return good.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()}), bad


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames whose columns differ; absent columns are null."""
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first
