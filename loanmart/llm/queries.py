"""The registered queries of this subpackage and, where SQL can say it, the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.llm import byte_bpe, conversation_trie, token_alignment
from loanmart.llm.decontaminate import benchmark_matches
from loanmart.llm.embedding_dedup import embedding_components
from loanmart.llm.license_scan import license_scan
from loanmart.llm.line_dedup import apply_bitmaps, line_bitmaps
from loanmart.llm.mixing import mixture
from loanmart.llm.pii import pii_spans
from loanmart.llm.quality import fit as fit_quality
from loanmart.llm.quality import quality_grades
from loanmart.llm.secret_scan import secret_spans
from loanmart.llm.simhash import simhash_components
from loanmart.llm.toxicity import fit as fit_toxicity
from loanmart.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A document is kept if it is at least of grade 1 with this probability.
KEEP_LIMIT = 0.4


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def quality_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings from the labels: 0 bad, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return table(spark, sf_dir, "labels").select("doc_id", grade.alias("grade"))


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, quality_ratings(spark, sf_dir))
    return quality_grades(docs, model, least=1, limit=KEEP_LIMIT)


@query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op8_mixing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents")).drop("t1", "t2")


@query("op9_decontaminate")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row", "t1", "t2")


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("op10_line_dedup", f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM parts),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANK})")} AS key FROM line),
shared AS (SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.*, (s.key IS NOT NULL AND k.doc_id <> s.top) AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = apply_bitmaps(docs, line_bitmaps(docs, min_chars=40, min_docs=5))
    return kept.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


@query("op1_embedding_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, w.component_id, v.vec_id = w.component_id AS kept
FROM v JOIN low w ON v.vec_id = w.a LEFT JOIN degree d ON v.vec_id = d.a""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"), limit=0.9)


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity(docs, model, limit=0.3)


@query("op6_pii")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans(table(spark, sf_dir, "documents"))


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


@query("op13_byte_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and bytes by the multilingual byte-level merges; SQL has no merge queue, see tests/llm/test_tokenizers.py."""
    import public_tokenizers

    ranks = byte_bpe.load_ranks(vocabulary("byte_bpe_multi_50k.tiktoken"))
    ids = byte_bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    whole = byte_bpe.decoded(ids.drop("text"), ranks)
    return whole.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two vocabularies; SQL has no tokenizers, see tests/llm/test_tokenizers.py."""
    left, right = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    found = token_alignment.aligned(table(spark, sf_dir, "documents").select("doc_id", "text"), left, right)
    # the groups' text is needed as a digest only
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    slim = found.withColumn("groups_sha256", digest).drop("text", "groups")
    return token_alignment.counted(slim, token_alignment.piece_count(right))


_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


@query("op11_conversation_trie", f"""
WITH turn AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
known AS (SELECT conv_id, turn, role, left(text, 32) AS begins, sha256(strlen(role) || ':' || role || text) AS id, strlen(text) AS bytes FROM turn),
own AS (SELECT conv_id, id, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, begins, id) - 1 AS pos FROM known),
conv AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)),
head AS (SELECT c.conv_id, o.pos, o.id, o.bytes FROM conv c JOIN own o ON o.conv_id = c.base WHERE o.pos < c.h),
rest AS (SELECT c.conv_id, 1000000 + o.pos AS pos, o.id, o.bytes FROM conv c JOIN own o ON o.conv_id = c.conv_id WHERE o.pos >= c.h),
whole AS (SELECT conv_id, bytes, row_number() OVER w AS depth, string_agg(id, '') OVER w AS prefix FROM (FROM head UNION ALL FROM rest)
          WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
member AS (SELECT conv_id, depth, prefix, bytes FROM whole UNION ALL SELECT conv_id, 0, '', 0 FROM conv),
last AS (SELECT conv_id, max(depth) AS depth FROM member GROUP BY conv_id),
node AS (SELECT prefix, depth, min(m.conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes, left(prefix, 64 * (depth - 1)) AS above,
         sha256(coalesce(string_agg(l.conv_id::VARCHAR, ',' ORDER BY l.conv_id), '')) AS ends
         FROM member m LEFT JOIN last l USING (conv_id, depth) GROUP BY prefix, depth),
child AS (SELECT above, count(*) AS n FROM node WHERE depth > 0 GROUP BY above),
part AS (SELECT n.prefix, left(n.prefix, 64 * i) AS top, (c.n IS NULL)::BIGINT AS leaf, (n_convs - 1) * bytes AS saved
         FROM node n LEFT JOIN child c ON c.above = n.prefix, unnest(range(0, n.depth + 1)) AS t(i)),
below AS (SELECT top, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved FROM part GROUP BY top)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.n_leaves, b.saved AS saved_tokens, n.ends AS ends_sha256
FROM node n JOIN below b ON b.top = n.prefix LEFT JOIN child c ON c.above = n.prefix LEFT JOIN node p ON n.depth > 0 AND p.prefix = n.above""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.conversation_turns(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(conversation_trie.rebuilt(turns))
