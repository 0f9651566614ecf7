"""Lines that many documents share, kept in one document only, as compressed keep bitmaps.

Method: every long line becomes a 128-bit hash. (hash, document) pairs are dealt by range and sorted by hash, document
and position, so that a stream over each partition sees a hash's first occurrence (the largest document) before the
others and decides with a buffer of fewer than ``min_docs`` documents. A range may cut a frequent hash into several
partitions; only the first and last hash of a partition can be cut, so at most two summaries for each partition settle
those. The result holds no text: one zlib bitmap of the kept lines for each document.

Defined cases: a null or empty text is one empty line and loses nothing. A null ``doc_id`` counts as one document below
all others. A document is an input row; rows that repeat a ``doc_id`` count once for the number of documents, and rows
equal in id and text get equal results. A line repeated inside the kept document stays each time. Other columns are
not read. No documents give no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.columns import free
from loanmart.llm.text import slices
from loanmart.session import settled

BLANK = " \t\n\x0b\x0c\r"
_LOWEST = -(1 << 63)
_LINES = "doc_id long, t1 long, t2 long, n_lines long, at array<int>, h1 array<long>, h2 array<long>"
_FOUND = "h1 long, h2 long, id long, row long, pos int, fresh long, state int"
DROP, OPEN, TOTAL = 0, 1, 2


def digests(text: str = "text") -> list:
    """Two 64-bit hashes of a text, by which its row is found again."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), F.col(text)).alias("t2")]


def _hashed(min_chars: int):
    def run(batches):
        for batch in slices(batches):
            counts, at, keys, many = [], [], [], []
            for text in batch.column("text").to_pylist():
                lines, before = (text or "").split("\n"), len(at)
                for i, line in enumerate(lines):
                    key = line.strip(BLANK)
                    if len(key) >= min_chars:
                        at.append(i)
                        keys.append(xxhash.xxh3_128_digest(key.encode("utf-8", "replace").lower()))
                counts.append(len(lines))
                many.append(len(at) - before)
            ends = pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32())
            h = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
            lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (np.array(at, dtype=np.int32), h[:, 0].copy(), h[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("t1"), batch.column("t2"), pa.array(counts, pa.int64()), *lists],
                ["doc_id", "t1", "t2", "n_lines", "at", "h1", "h2"])

    return run


def _streamed(min_docs: int):
    """Decide rows sorted by hash, falling id, row and position."""

    def run(batches):
        # the hash in progress: is it the partition's first, documents so far, first and last id, rows not decided
        key, first, docs, top, last, held = None, True, 0, None, None, []

        def out(rows, state):
            n = len(rows["pos"])
            return pa.RecordBatch.from_arrays([pa.array(rows[c]) for c in ("h1", "h2", "id", "row", "pos", "fresh")]
                                              + [pa.array(np.full(n, state, dtype=np.int32))],
                                              ["h1", "h2", "id", "row", "pos", "fresh", "state"])

        def part(rows, pick):
            return {k: v[pick] for k, v in rows.items()}

        def joined(parts):
            return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}

        for batch in batches:
            if not batch.num_rows:
                continue
            x = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "id", "row", "pos")}
            n = len(x["id"])
            begin = np.ones(n, dtype=bool)
            begin[1:] = (x["h1"][1:] != x["h1"][:-1]) | (x["h2"][1:] != x["h2"][:-1])
            begin[0] = key != (x["h1"][0], x["h2"][0])
            fresh = begin.copy()
            fresh[1:] |= x["id"][1:] != x["id"][:-1]
            fresh[0] = begin[0] or x["id"][0] != last
            x["fresh"] = fresh.astype(np.int64)
            cuts = np.flatnonzero(begin)
            lead = cuts[0] if len(cuts) else n
            if lead:  # more rows of the hash in progress
                rows = part(x, slice(0, lead))
                docs += int(rows["fresh"].sum())
                if first:
                    yield out(rows, OPEN)
                else:
                    held.append(rows)
                    if docs >= min_docs:
                        rows = joined(held)
                        yield out(part(rows, rows["id"] != top), DROP)
                        held = []
            if len(cuts):
                if not first and held:  # ended below min_docs
                    held = []
                run_of = np.cumsum(begin) - 1  # -1 for the lead
                inner = run_of >= 0
                many = np.bincount(run_of[inner], weights=x["fresh"][inner])
                tops = x["id"][cuts]
                whole = inner & (run_of < len(cuts) - 1)
                begins_partition = key is None
                if begins_partition:
                    whole &= run_of > 0
                drop = whole.copy()
                drop[whole] = (many[run_of[whole]] >= min_docs) & (x["id"][whole] != tops[run_of[whole]])
                if drop.any():
                    yield out(part(x, drop), DROP)
                if begins_partition and len(cuts) > 1:
                    yield out(part(x, slice(0, cuts[1])), OPEN)
                first = begins_partition and len(cuts) == 1
                rows = part(x, slice(cuts[-1], n))
                key, docs, top = (x["h1"][-1], x["h2"][-1]), int(many[-1]), tops[-1]
                if first:
                    yield out(rows, OPEN)
                elif docs >= min_docs:
                    yield out(part(rows, rows["id"] != top), DROP)
                else:
                    held = [rows]
            last = x["id"][-1]
        if key is not None and not first:
            if held:
                yield out(joined(held), OPEN)
            elif docs >= min_docs:
                one = {"h1": np.array([key[0]]), "h2": np.array([key[1]]), "id": np.array([top]), "row": np.array([-1]),
                       "pos": np.array([-1], dtype=np.int32), "fresh": np.array([docs], dtype=np.int64)}
                yield out(one, TOTAL)

    return run


def _bitmaps(batches):
    plain: dict[int, bytes] = {}
    for batch in batches:
        kept = []
        for n, at in zip(batch.column("n_lines").to_pylist(), batch.column("dropped").to_pylist()):
            if not at and n in plain:
                kept.append(plain[n])
                continue
            bits = np.ones(n, dtype=np.uint8)
            bits[at or []] = 0
            kept.append(zlib.compress(np.packbits(bits).tobytes()))
            if not at and len(plain) < 10_000:
                plain[n] = kept[-1]
        n_dropped = pa.array([len(at or ()) for at in batch.column("dropped").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "t1", "t2", "n_lines")), n_dropped, pa.array(kept, pa.binary())],
                                         ["doc_id", "t1", "t2", "n_lines", "n_dropped", "keep"])


def line_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``doc_id``, ``t1``, ``t2`` (the text's hashes), ``n_lines``, ``n_dropped``, ``keep`` for each row of ``docs``.

    Lines (stripped, A-Z lower-cased) of ``min_chars`` code points found in ``min_docs`` documents are dropped but for
    the largest ``doc_id`` holding them. ``keep`` is the zlib form of a bit for each line, first line first.
    """
    hashed = docs.select(F.col("doc_id").cast("long"), "text", *digests()).mapInArrow(_hashed(min_chars), _LINES)
    table = settled(hashed.withColumn("row", F.monotonically_increasing_id()), "lines")
    lines = table.select("row", F.coalesce("doc_id", F.lit(_LOWEST)).alias("id"), F.explode(F.arrays_zip("at", "h1", "h2")).alias("x"))
    order = [F.col("h1"), F.col("h2"), F.col("id").desc()]
    ranged = lines.select("x.h1", "x.h2", "id", "row", F.col("x.at").alias("pos")).repartitionByRange(*order)
    found = settled(ranged.sortWithinPartitions(*order, "row", "pos").mapInArrow(_streamed(min_docs), _FOUND), "shared-lines")
    # at most two hashes for each partition
    cut = found.where(F.col("state") != DROP).groupBy("h1", "h2").agg(F.sum("fresh").alias("n"), F.max("id").alias("top"))
    late = found.where(F.col("state") == OPEN).join(F.broadcast(cut.where(F.col("n") >= min_docs)), ["h1", "h2"]).where("id < top")
    drops = found.where(F.col("state") == DROP).select("row", "pos").unionByName(late.select("row", "pos"))
    dropped = drops.groupBy("row").agg(F.sort_array(F.collect_list("pos")).alias("dropped"))
    rows = table.select("row", "doc_id", "t1", "t2", "n_lines").join(dropped, "row", "left")
    return rows.mapInArrow(_bitmaps, "doc_id long, t1 long, t2 long, n_lines long, n_dropped long, keep binary")


def _kept(text: pd.Series, n_lines: pd.Series, keep: pd.Series) -> pd.Series:
    def one(t, n, k):
        t = t or ""
        if k is None:
            return t
        bits = np.unpackbits(np.frombuffer(zlib.decompress(k), dtype=np.uint8), count=n)
        return "\n".join(line for line, b in zip(t.split("\n"), bits) if b)

    return pd.Series([one(*x) for x in zip(text, n_lines, keep)], dtype=object)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, made: tuple[str, str] = ("__n_lines", "__n_dropped")) -> DataFrame:
    """``docs`` with ``text`` cut to the kept lines (null becomes empty); all its columns, then the two numbers, named ``made``."""
    if clash := {c.lower() for c in made} & {c.lower() for c in docs.columns}:
        raise ValueError(f"there are columns {sorted(clash)} already")
    t1, t2, i, b1, b2, keep = free([*docs.columns, *made], "__t1", "__t2", "__id", "__b1", "__b2", "__keep")
    own = docs.withColumns({t1: digests()[0], t2: digests()[1]})
    marks = bitmaps.select(F.col("doc_id").alias(i), F.col("t1").alias(b1), F.col("t2").alias(b2), F.col("n_lines").alias(made[0]),
                           F.col("n_dropped").alias(made[1]), F.col("keep").alias(keep)).dropDuplicates([i, b1, b2])
    on = (F.col("doc_id").cast("long").eqNullSafe(F.col(i))) & (F.col(t1) == F.col(b1)) & (F.col(t2) == F.col(b2))
    whole = own.join(marks.hint("shuffle_hash"), on)
    # rows that lose nothing hand no bitmap to Python
    text = F.pandas_udf(_kept, "string")("text", made[0], F.when(F.col(made[1]) > 0, F.col(keep)))
    return whole.withColumn("text", text).select(*docs.columns, *made)


def without_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut to the kept lines, with their own columns, whatever these are called."""
    return apply_bitmaps(docs, bitmaps, tuple(free(docs.columns, "__n_lines", "__n_dropped"))).select(*docs.columns)
