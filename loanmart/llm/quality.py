"""Quality grades by ordinal cumulative-link regression on hashed text.

Method: one weight vector over hashed features, shared by all grades, and ordered thresholds: ``P(grade > k) =
sigmoid(w.x - threshold_k)``. Features are shares of a text's words in hashed buckets: each word (lower-cased), its shape (runs of
letters, digits and signs) and whether it repeats the word before. The fit reads a bounded sample of graded rows
(``MAX_TRAIN``, by smallest id hash) and only its bucket counts reach the driver; scoring covers every row and whole
texts. The result has the expected grade and the tail probabilities, and ``keep`` where ``P(grade >= least)`` reaches
the limit.

Defined cases: null and empty texts have no features and get the score of the thresholds alone, but are never kept.
Grades of rows whose id is null, or null grades, are not read; an id graded more than once has its lowest grade. With
fewer than two grades there is nothing to tell apart: every text with words is kept with tail probability 1. Every row
gets its row; other columns are not read. No documents give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.columns import free
from loanmart.llm.text import mixed, raw, slices, spaced_codes, span_hashes, sums, words

BUCKETS = 1 << 15
#: Graded rows read for the fit.
MAX_TRAIN = 4_000
EPOCHS, RATE, RIDGE = 80, 0.5, 3e-4

_EXAMPLES = "doc_id long, bucket binary, share binary"


@dataclass
class OrdinalModel:
    """``grades`` in order, weights by bucket, and one threshold fewer than grades."""

    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, z: np.ndarray) -> np.ndarray:
        """``P(grade > grades[k])`` by row and k."""
        return _sigmoid(z[:, None] - self.thresholds[None, :])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _shapes() -> np.ndarray:
    t = np.arange(1, 257, dtype=np.uint16)
    for a, b, to in ((65, 91, 65), (97, 123, 97), (48, 58, 48), (128, 256, 97)):
        t[a:b] = to + 1
    return t


def features(column: pa.Array):
    """Bucket and text of every feature of the texts, and the number of words of each text."""
    data, offsets = raw(column)
    codes = spaced_codes()
    w = words(data, offsets, codes)
    shape = _shapes()[data]
    head = np.ones(len(data), dtype=bool)
    head[1:] = shape[1:] != shape[:-1]
    head[w.starts] = True
    at = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(head, out=at[1:])
    shapes = span_hashes(shape[head], at[w.starts], at[w.ends])
    again = np.zeros(len(w.doc), dtype=bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    half = np.uint64(BUCKETS // 2)
    bucket = np.stack([w.hash % half, half + mixed(shapes + np.uint64(1)) % (half - np.uint64(1)),
                       np.where(again, np.uint64(BUCKETS - 1), np.uint64(BUCKETS))], axis=1).astype(np.int64)
    return bucket, w


def _examples(batches):
    for batch in slices(batches):
        bucket, w = features(batch.column("text"))
        buckets, shares = [], []
        for i, n in enumerate(w.counts):
            b, c = np.unique(bucket[w.bounds[i]:w.bounds[i + 1]], return_counts=True)
            buckets.append(b[b < BUCKETS].astype("<i4").tobytes())
            shares.append((c[b < BUCKETS] / max(n, 1)).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(buckets, pa.binary()), pa.array(shares, pa.binary())],
                                         ["doc_id", "bucket", "share"])


def fit(docs: DataFrame, graded: DataFrame, grade: str = "grade", max_train: int = MAX_TRAIN) -> OrdinalModel:
    """Fit on at most ``max_train`` rows of ``graded`` (``doc_id``, ``grade``)."""
    marks = graded.where(F.col("doc_id").isNotNull() & F.col(grade).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(grade).cast("int").alias("g"))
    chosen = [(r.doc_id, r.g) for r in marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train).collect()]  # max_train pairs
    known = dict(chosen)
    grades = sorted(set(known.values()))
    weights = np.zeros(BUCKETS + 1)
    if len(grades) < 2:
        return OrdinalModel(grades, weights, np.zeros(0))
    ids = docs.sparkSession.createDataFrame([(i,) for i in known], "__id long")
    picked = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(ids), F.col("doc_id") == F.col("__id"), "left_semi")
    got = picked.dropDuplicates(["doc_id"]).mapInArrow(_examples, _EXAMPLES).collect()
    got = sorted((r for r in got if len(r.bucket)), key=lambda r: r.doc_id)
    if not got:
        return OrdinalModel(grades, weights, np.arange(len(grades) - 1, dtype=float))
    row = np.repeat(np.arange(len(got)), [len(r.bucket) // 4 for r in got])
    col = np.frombuffer(b"".join(r.bucket for r in got), dtype="<i4")
    x = np.sqrt(np.frombuffer(b"".join(r.share for r in got), dtype="<f4"))  # damped, as in `scores`
    y = np.searchsorted(grades, [known[r.doc_id] for r in got])
    return _fit(row, col, x, y, grades)


def _fit(row, col, x, y, grades) -> OrdinalModel:
    """Adam on the mean negative log likelihood; thresholds stay ordered as a first value and positive steps."""
    n, k = len(y), len(grades) - 1
    share = np.clip(np.array([(y > j).mean() for j in range(k)]), 1e-3, 1 - 1e-3)
    start = -np.log(share / (1 - share))
    first = start[0]
    step = np.log(np.maximum(np.diff(start), 1e-2))
    p = np.concatenate([np.zeros(BUCKETS + 1), [first], step])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, EPOCHS + 1):
        w, theta = p[:BUCKETS + 1], np.concatenate([[p[BUCKETS + 1]], p[BUCKETS + 1] + np.cumsum(np.exp(p[BUCKETS + 2:]))])
        z = np.bincount(row, weights=x * w[col], minlength=n)
        upper = np.concatenate([np.ones((n, 1)), _sigmoid(z[:, None] - theta[None, :]), np.zeros((n, 1))], axis=1)  # P(y >= j)
        a, b = upper[np.arange(n), y], upper[np.arange(n), y + 1]
        likely = np.maximum(a - b, 1e-9)
        da, db = a * (1 - a) / likely, b * (1 - b) / likely
        dz = -(da - db) / n
        g = np.zeros_like(p)
        g[:BUCKETS + 1] = np.bincount(col, weights=x * dz[row], minlength=BUCKETS + 1) + RIDGE * w
        dtheta = np.zeros(k + 2)
        np.add.at(dtheta, y, da / n)
        np.add.at(dtheta, y + 1, -db / n)
        dtheta = dtheta[1:k + 1]
        g[BUCKETS + 1] = dtheta.sum()
        g[BUCKETS + 2:] = np.cumsum(dtheta[::-1])[::-1][1:] * np.exp(p[BUCKETS + 2:])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - RATE * (1 - t / (EPOCHS + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    theta = np.concatenate([[p[BUCKETS + 1]], p[BUCKETS + 1] + np.cumsum(np.exp(p[BUCKETS + 2:]))])
    return OrdinalModel(list(grades), p[:BUCKETS + 1], theta)


GRADED = ("__n_words", "__expected", "__tail", "__keep")


def graded_by(docs: DataFrame, model: OrdinalModel, least: int, limit: float = 0.5, made: Sequence[str] = GRADED) -> DataFrame:
    """``docs`` (all columns) with number of words, expected grade, P(grade >= least) and whether to keep, named ``made``."""
    if clash := {c.lower() for c in made} & {c.lower() for c in docs.columns}:
        raise ValueError(f"there are columns {sorted(clash)} already")
    wanted = [i for i, g in enumerate(model.grades) if g >= least]
    at = wanted[0] - 1 if wanted else None  # P(grade > grades[at])
    weights = model.weights

    def scores(column: pa.Array):
        bucket, w = features(column)
        z = np.zeros(len(column))
        n = np.maximum(w.counts, 1)
        if len(w.doc):
            key = (w.doc[:, None] * (BUCKETS + 1) + bucket).ravel()
            key = key[bucket.ravel() < BUCKETS]
            key, c = np.unique(key, return_counts=True)
            doc = key // (BUCKETS + 1)
            z += np.bincount(doc, weights=weights[key % (BUCKETS + 1)] * np.sqrt(c / n[doc]), minlength=len(column))
        return z, w.counts

    def run(batches):
        for batch in slices(batches):
            z, n = scores(batch.column("text"))
            if len(model.grades) < 2 or at is None or at < 0:
                tail, expected = np.ones(len(z)) * (at is not None or not model.grades), np.full(len(z), float(model.grades[0] if model.grades else 0))
            else:
                tails = model.tails(z)
                tail = tails[:, at]
                expected = model.grades[0] + tails @ np.diff(model.grades)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(expected), pa.array(tail), pa.array((n > 0) & (tail >= limit))],
                                             [*batch.schema.names, *made])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    added = ", ".join(f"`{c}` {t}" for c, t in zip(made, ("long", "double", "double", "boolean")))
    return docs.mapInArrow(run, f"{schema}, {added}")


def good_rows(docs: DataFrame, model: OrdinalModel, least: int, limit: float = 0.5) -> DataFrame:
    """Rows of ``docs`` to keep, with their own columns, whatever these are called."""
    made = free(docs.columns, *GRADED)
    return graded_by(docs, model, least, limit, made).where(F.col(made[-1])).select(*docs.columns)


def quality_grades(docs: DataFrame, model: OrdinalModel, least: int, limit: float = 0.5) -> DataFrame:
    """``doc_id``, ``n_words``, ``expected_grade``, ``tail_prob``, ``keep`` of each row."""
    own = docs.select(F.col("doc_id").cast("long"), "text")
    return graded_by(own, model, least, limit).select("doc_id", F.col("__n_words").alias("n_words"), F.col("__expected").alias("expected_grade"),
                                                      F.col("__tail").alias("tail_prob"), F.col("__keep").alias("keep"))
