"""A corpus made ready for training: five stages over ``documents``, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.llm import decontaminate, line_dedup, mixing, quality, simhash
from loanmart.llm.queries import KEEP_LIMIT, quality_ratings, table
from loanmart.session import settled


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rates grade 1 or better."""
    model = quality.fit(docs, quality_ratings(spark, sf_dir))
    return quality.good_rows(docs, model, least=1, limit=KEEP_LIMIT)


def shared_lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that another document keeps; ``n_chars`` follows the text."""
    kept = line_dedup.without_lines(docs, line_dedup.line_bitmaps(docs, min_chars=40, min_docs=5))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near copies."""
    return simhash.one_of_each(docs, simhash.simhash_components(docs, words=3, max_bits=3))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.without_matches(docs, decontaminate.benchmark_matches(docs, table(spark, sf_dir, "benchmark")), null_ids_stay=False)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by raked probabilities, with ``mix_weight``."""
    return mixing.sampled(docs, mixing.mixture(docs))


STAGES = [("quality", good_quality), ("line_dedup", shared_lines_once), ("simhash", near_copies_once),
          ("decontaminate", no_benchmark), ("mixing", mixed)]

#: No SQL: fingerprints, alignment and raking are beyond it; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = settled(docs, name)
    return docs
