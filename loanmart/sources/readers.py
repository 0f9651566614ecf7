"""Sources: document collections, JDBC, files, catalog tables, text search.

Connections are always options the caller supplies.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOC_SCHEMA = "_id string, number bigint, created timestamp, doc string"


def plain_json(doc: Column) -> Column:
    """Extended JSON scalars (``{"$numberLong": "5"}``, ``{"$date": "..."}`` and the like) as their plain values."""
    wrapped = r'\{\s*"\$(?:oid|date|numberLong|numberInt|numberDouble|numberDecimal)"\s*:\s*("[^"]*"|[-0-9.eE+]+)\s*\}'
    inner = F.regexp_replace(doc, wrapped, "$1")  # a date may hold a wrapped number
    return F.regexp_replace(inner, wrapped, "$1")


def read_docs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Documents with key columns beside the JSON text, so key filters reach the scan.

    ``parquet`` or ``orc`` hold the columns of ``DOC_SCHEMA``; ``json`` holds one whole document per line.
    """
    if fmt == "json":
        lines = spark.read.text(path).select(plain_json(F.col("value")).alias("doc"))
        head = F.try_variant_get(F.try_parse_json("doc"), "$", "struct<_id:string,number:string,created:string>")
        when = F.col("h.created")
        return lines.select("doc", head.alias("h")).select(
            F.col("h._id").alias("_id"),
            F.col("h.number").try_cast("bigint").alias("number"),
            F.when(when.rlike("^-?[0-9]+$"), F.timestamp_millis(when.try_cast("bigint"))).otherwise(when.try_cast("timestamp")).alias("created"),
            "doc",
        )
    return spark.read.format(fmt).load(path)


def read_collection(spark: SparkSession, options: Mapping[str, str], fmt: str = "mongodb") -> DataFrame:
    """A document collection through whatever connector is on the caller's class path."""
    raw = spark.read.format(fmt).options(**options).load()
    return raw.select(
        F.col("_id").cast("string").alias("_id"),
        F.col("number").cast("bigint").alias("number"),
        F.col("created").cast("timestamp").alias("created") if "created" in raw.columns
        else F.lit(None).cast("timestamp").alias("created"),
        F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSS", "timeZone": "UTC"}).alias("doc"),
    )


def jdbc_options(connection: Mapping[str, str], *, query: str | None = None, table: str | None = None,
                 fetchsize: int = 1000) -> dict[str, str]:
    """Reader options for one query or table."""
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    source = {"dbtable": f"({query}) q"} if query else {"dbtable": table}
    return {"fetchsize": str(fetchsize), **connection, **source}


def read_jdbc(spark: SparkSession, connection: Mapping[str, str], *, query: str | None = None,
              table: str | None = None, predicates: Sequence[str] | None = None, fetchsize: int = 1000) -> DataFrame:
    """JDBC scan; each predicate becomes one partition, read in parallel."""
    options = jdbc_options(connection, query=query, table=table, fetchsize=fetchsize)
    if not predicates:
        return spark.read.format("jdbc").options(**options).load()
    props = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=list(predicates), properties=props)


def sql_literal(value) -> str:
    """A value as SQL text for a pushed predicate."""
    if isinstance(value, bool) or value is None:
        return "NULL" if value is None else str(value).upper()
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"
    if isinstance(value, dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    return "'" + str(value).replace("'", "''") + "'"


def month_bounds(start: dt.date, end: dt.date) -> list[tuple[dt.date, dt.date]]:
    """First and last day of every month from ``start`` to ``end``, cut at both."""
    out, at = [], start
    while at <= end:
        nxt = dt.date(at.year + at.month // 12, at.month % 12 + 1, 1)
        out.append((at, min(nxt - dt.timedelta(days=1), end)))
        at = nxt
    return out


def month_predicates(column: str, start: dt.date, end: dt.date) -> list[str]:
    """One predicate per month, as partitions of a JDBC scan. Half-open, so times on the last day are kept."""
    return [
        f"{column} >= {sql_literal(a)} AND {column} < {sql_literal(b + dt.timedelta(days=1))}"
        for a, b in month_bounds(start, end)
    ]


def product_month_predicates(product_column: str, products: Iterable, column: str, start: dt.date,
                             end: dt.date) -> list[str]:
    """One predicate per product and month."""
    months = month_predicates(column, start, end)
    return [f"{product_column} = {sql_literal(p)} AND {m}" for p in products for m in months]


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with a header line and a given schema; a header that differs from the schema is an error."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def table_or_empty(spark: SparkSession, name: str, schema: str | T.StructType) -> DataFrame:
    """A catalog table, or an empty frame when it does not exist."""
    return spark.read.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def first_column(df: DataFrame) -> DataFrame:
    """The first column only, to feed a join."""
    return df.select(df.columns[0])


def key_exists(df: DataFrame, key: str, value) -> DataFrame:
    """One row (present) that tells whether a key value occurs; at most one row is read per partition."""
    hit = df.where(F.col(key) == F.lit(value)).limit(1)
    return hit.agg((F.count("*") > 0).alias("present"))


def clean_names(df: DataFrame) -> DataFrame:
    """Give blank column names a name; repeats get a number."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        base = c if c.strip() else "Unnamed_column"
        seen[base] = seen.get(base, 0) + 1
        names.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return df.toDF(*names)


def param_sql(spark: SparkSession, text: str, args: Mapping | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with bound parameters; ``{name}`` places refer to the given frames."""
    return spark.sql(text, args=dict(args or {}), **frames)


def copy(source: DataFrame, transform: Callable[[DataFrame], DataFrame] = lambda d: d,
         columns: Sequence[str] | None = None) -> DataFrame:
    """Extract, transform, and pick the columns to load."""
    out = source.transform(transform)
    return out.select(*columns) if columns else out


def find_lines(df: DataFrame, text: str, needle: str, keep: Sequence[str]) -> DataFrame:
    """Lines of a text column that hold a substring: the kept columns, line number from 1, stripped line.

    Rows without the substring are dropped before any line is split.
    """
    lines = df.where(F.col(text).contains(needle)).select(*keep, F.posexplode(F.split(text, "\r\n|\r|\n")))
    return lines.where(F.col("col").contains(needle)).select(
        *keep,
        (F.col("pos") + 1).alias("line_number"),
        F.regexp_replace("col", r"^\s+|\s+$", "").alias("line"),
    )


def find_in_files(spark: SparkSession, path: str, needle: str, glob: str | None = None) -> DataFrame:
    """Search a file tree: file path, line number, stripped line.

    Files are read in splits of any number. A line's number is its place in the split plus the lines of the splits
    before it, which come from one small aggregate (a row per split).
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    split = ["file_path", "_start"]
    # the id counts up without gaps inside a split
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    sizes = lines.groupBy(*split).agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("file_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(*split, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    hits = lines.where(F.col("value").contains(needle))
    return hits.join(shift, split).select(
        "file_path",
        (F.col("_id") - F.col("_first") + F.col("_before") + 1).alias("line_number"),
        F.regexp_replace("value", r"^\s+|\s+$", "").alias("line"),
    )


def valid_identifier(name: str) -> str:
    """A table name made of plain parts, checked before it is placed in SQL text."""
    if not re.fullmatch(r"\w+(\.\w+){0,2}", name):
        raise ValueError(f"not a table name: {name!r}")
    return name
