"""SimHash near copies: inverted index over byte positions of the fingerprints, with count filtering.

Two 64-bit fingerprints that differ in at most 3 bits share at least 5 of their 8 bytes in place. A posting list for
one byte holds 1/256 of all fingerprints, so lists are kept for four positions at once: of the 14 position sets
{a, b, c, d} with a^b^c^d = 0, any 5 shared positions contain one whole (the sets are a Steiner system, so every 3
positions left out are avoided by one). Fingerprints that meet in a list get their shared positional bytes tallied;
pairs with at least 8 - ``max_bits`` are verified by bit distance. Lists longer than ``block`` are cut into blocks, and
each pair of blocks is one unit of work, so no list is gathered in one task; a unit returns a spanning forest of its
links, not the pairs. Distinct fingerprints stand for all their documents.

Defined cases: null or empty text, or white space only, has fingerprint zero, linked like any other. Every row gets its
row; rows with a null ``doc_id`` have a fingerprint and take part in links, and ``component_id`` is the smallest id
that is not null (null if there is none). Other columns are not read. No documents give no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.columns import free
from loanmart.llm.graph import components
from loanmart.llm.text import slices
from loanmart.session import settled

POSITION_SETS = [s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]


def fingerprint(text: str | None, words: int = 3) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles; a signed 64-bit number."""
    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return 0
    line = b" ".join(w)
    if len(w) <= words:
        h = [xxhash.xxh64_intdigest(line, 42)]
    else:
        sizes = np.fromiter(map(len, w), dtype=np.int64, count=len(w)) + 1
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[:len(w) - words + 1].tolist()
        stops = (ends - 1)[words - 1:].tolist()
        f = xxhash.xxh64_intdigest
        h = [f(line[a:b], 42) for a, b in zip(starts, stops)]
    n, ones = len(h), np.zeros(64, dtype=np.int64)
    bits = np.array(h, dtype="<u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, n, 4096):
        ones += np.unpackbits(bits[at:at + 4096], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id``, ``t1``, ``t2`` (the text's hashes), ``fp`` (long) for each row."""

    def run(batches):
        for batch in slices(batches):
            fp = [fingerprint(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "t1", "t2")), pa.array(fp, pa.int64())], ["doc_id", "t1", "t2", "fp"])

    hashed = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    return hashed.mapInArrow(run, "doc_id long, t1 long, t2 long, fp long")


def _posting(s: tuple[int, ...], number: int):
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
    key = F.lit(number).cast("long")
    for p in s:
        key = F.shiftleft(key, 8).bitwiseOR(byte(p))
    return key


def _forest(max_bits: int):
    """Star links of the components that each unit (rows with one ``key``, ``t1``, ``t2``) has, over sorted rows."""

    def links(unit: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        label = np.arange(len(fp))
        pairs_a, pairs_b = [], []
        alive, lag = np.arange(len(fp)), 1
        while True:
            alive = alive[alive + lag < len(fp)]
            alive = alive[unit[alive] == unit[alive + lag]]
            if not len(alive):
                break
            differ = fp[alive] ^ fp[alive + lag]
            shared = 8 - (differ.view(np.uint8).reshape(-1, 8) != 0).sum(axis=1)
            near = shared >= 8 - max_bits
            near[near] = np.bitwise_count(differ[near]) <= max_bits
            pairs_a.append(alive[near])
            pairs_b.append(alive[near] + lag)
            lag += 1
        if pairs_a:
            a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
            while True:  # smallest number reached by links
                low = np.minimum(label[a], label[b])
                fresh = label.copy()
                np.minimum.at(fresh, a, low)
                np.minimum.at(fresh, b, low)
                fresh = fresh[fresh]
                if (fresh == label).all():
                    break
                label = fresh
        far = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[far].view(np.int64)), pa.array(fp[label[far]].view(np.int64))], ["a", "b"])

    def run(batches):
        rest_u, rest_f, number, last = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "t1", "t2")], axis=1)
            new = np.ones(len(k), dtype=bool)
            new[1:] = (k[1:] != k[:-1]).any(axis=1)
            new[0] = last is not None and tuple(k[0]) != last
            unit = number + np.cumsum(new)
            number, last = int(unit[-1]), tuple(k[-1])
            unit = np.concatenate([rest_u, unit])
            fp = np.concatenate([rest_f, batch.column("fp").to_numpy().astype(np.int64).view(np.uint64)])
            cut = int(np.searchsorted(unit, number))  # the last unit may go on in the next batch
            if cut:
                yield links(unit[:cut], fp[:cut])
            rest_u, rest_f = unit[cut:], fp[cut:]
        if len(rest_f):
            yield links(rest_u, rest_f)

    return run


def linked_fingerprints(fps: DataFrame, max_bits: int = 3, block: int = 512) -> DataFrame:
    """``node``, ``root`` for each of the distinct fingerprints ``fp`` that has one at ``max_bits`` or fewer."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the position sets serve distances up to 3 bits")
    postings = fps.select("fp", F.explode(F.array(*[_posting(s, i) for i, s in enumerate(POSITION_SETS)])).alias("key"))
    sizes = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    cut = postings.join(sizes, "key").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    met = cut.select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    units = met.select("key", F.least("own", "other").alias("t1"), F.greatest("own", "other").alias("t2"), "fp")
    order = ["key", "t1", "t2"]
    links = units.repartition(*order).sortWithinPartitions(*order).mapInArrow(_forest(max_bits), "a long, b long")
    return components(links)


def simhash_components(docs: DataFrame, words: int = 3, max_bits: int = 3, block: int = 512) -> DataFrame:
    """``doc_id``, ``fp``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id linked), ``root`` (a component's
    fingerprint), ``t1``, ``t2`` (the text's hashes) for each row."""
    rows = settled(fingerprints(docs, words), "fingerprints")
    fps = settled(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    roots = linked_fingerprints(fps, max_bits, block)
    rooted = settled(fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "low"), "roots")
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of = rooted.select("fp", "root").join(lows, "root").select("fp", "root", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(of, "fp").select("doc_id", "fp", digits.alias("fingerprint"), "component_id", "root", "t1", "t2")


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component in ``found``: with the smallest id that is not null, then by text hashes.

    Decisions are made for id and text: rows that repeat an id with another text belong to their own texts' components.
    """
    from pyspark.sql import Window

    id_, none, t1, t2, n = names = free(docs.columns, "__id", "__none", "__t1", "__t2", "__n")
    key = list(names[:4])

    def keyed(doc_id, a, b) -> list:
        # a null id as two columns that are never null, so that the join and the numbering share one partitioning
        return [F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")).alias(id_), doc_id.isNull().alias(none), a.alias(t1), b.alias(t2)]

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("t1").alias("a"), F.col("t2").alias("b")))
    kept = found.groupBy("root").agg(first.alias("k")).select("k.*")
    kept = kept.select(*keyed(F.col("id"), F.col("a"), F.col("b")))
    own = docs.select("*", *keyed(F.col("doc_id"), F.xxhash64("text"), F.xxhash64(F.lit(1), F.col("text"))))
    # rows equal in id and text are one
    numbered = own.join(kept, key, "left_semi").withColumn(n, F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0))))
    return numbered.where(F.col(n) == 1).select(*docs.columns)
