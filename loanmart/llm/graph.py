"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.session import remove_dir, settle


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) of every node with a link, for links ``a``, ``b`` (long).

    Each round hangs the larger neighbours of a node on the smallest one, then the smaller ones; it ends when a round
    changes nothing, and then every node points at its root. Nodes' neighbours are never gathered: a round is a
    minimum by key, counted in each task first, and a join of the links with it, row by row; a hub's rows of that join
    fall to one partition, which Spark splits when it is large. Each round is written to the shared folder, and the one
    before removed. Loops and nulls are left out; no links give no rows.
    """
    spark = links.sparkSession
    first = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, path = settle(first, "links")
    seen = _mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, fresh = settle(small.unionByName(low.toDF("u", "v")).distinct(), "links")
        remove_dir(spark, path)
        path, before, seen = fresh, seen, _mark(edges)
        if before == seen:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
