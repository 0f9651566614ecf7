"""Toxic documents and the sentences that make them so: multiple-instance learning with noisy-or.

Method: a sentence's score is ``sigmoid(bias + sum of its words' weights)``, and a document is toxic unless every
sentence fails to be: ``1 - prod(1 - score)``. Weights of words and of their first bytes, and the bias, are trained from
document labels alone. The words that may have a weight are those whose document counts lean far from the label's share;
they are counted over all labelled training rows, whose words travel as sets of buckets, not as text. Only the fit reads a
bounded sample (``MAX_TRAIN``, by smallest id hash): half of each label, or all rows of a label that has fewer, weighted
so that the labels count by their shares of all rows. Scoring covers every row and whole texts, and sentences with
``SENTENCE_LIMIT`` or more are named.

Words are runs of 0-9, A-Z (as a-z) and characters beyond ASCII; sentences end at . ! ? or a line break, as a run.

Defined cases: null and empty texts are one empty sentence. A null ``doc_id`` has no label and ``held_out`` false. Null
labels are not read, an id labelled more than once has its highest label. Without both labels among the training rows every
document scores the share of label 1 (0 without labels). Every row gets its row; other columns are not read. No
documents give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.llm.text import mixed, raw, slices, span_hashes, sums, word_codes, words
from loanmart.session import settled

BUCKETS = 1 << 18
#: Labelled rows read for the fit; words that may have a weight; least documents that a word must be in.
MAX_TRAIN, VOCABULARY, LEAST_DOCS = 16_000, 4_096, 4
#: Bytes at a word's beginning that are a feature of their own.
STEM = 4
#: Standard deviations by which such a word's toxic documents must be off the label's share.
LEAST_LEAN = 3.0
EPOCHS, RATE, RIDGE = 200, 0.1, 0.2
SENTENCE_LIMIT = 0.3


@dataclass
class ToxicModel:
    """Weight by bucket (0 for most), bias of a sentence; a constant score where nothing could be learned."""

    weights: np.ndarray
    bias: float
    constant: float | None = None


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _softplus(z):
    return np.logaddexp(0, z)


def _sentences(column: pa.Array):
    """Words with the buckets of word and stem; first byte of every sentence with words, its text, and each word's sentence."""
    data, offsets = raw(column)
    w = words(data, offsets, word_codes())
    stop = np.zeros(256, dtype=bool)
    stop[[10, 33, 46, 63]] = True
    ended = np.concatenate([[0], np.cumsum(stop[data])])
    before = ended[w.starts]
    head = np.ones(len(w.doc), dtype=bool)
    head[1:] = (before[1:] != before[:-1]) | (w.doc[1:] != w.doc[:-1])
    sentence = np.cumsum(head) - 1
    stems = span_hashes(word_codes()[data], w.starts, np.minimum(w.starts + STEM, w.ends))
    bucket = np.stack([w.hash % np.uint64(BUCKETS), mixed(stems + np.uint64(1)) % np.uint64(BUCKETS)], axis=1)
    return data, offsets, w, bucket.astype(np.int64), head, sentence


def _once(sentence: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each bucket of a sentence once, so that a word said many times weighs as one."""
    key = np.unique(sentence[:, None] * BUCKETS + bucket)
    return key // BUCKETS, key % BUCKETS


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose label is not for learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _bucket_sets(batches):
    """Buckets of each document, rising, as steps from one to the next."""
    for batch in slices(batches):
        _, _, w, bucket, _, _ = _sentences(batch.column("text"))
        pair = np.unique(w.doc[:, None] * BUCKETS + bucket)
        of, at = pair // BUCKETS, pair % BUCKETS
        steps = np.diff(at, prepend=0)
        first = np.flatnonzero(np.diff(of, prepend=-1))
        steps[first] = at[first]
        ends = pa.array(np.searchsorted(of, np.arange(batch.num_rows + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(steps.astype(np.int32)))], ["doc_id", "steps"])


def _word_counts(batches):
    """Documents and toxic documents by bucket, one set of rows for each task."""
    total, toxic, n, n_toxic = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64), 0, 0
    for batch in batches:
        label = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        lists = batch.column("steps")
        ends = np.cumsum(np.concatenate([[0], lists.value_lengths().to_numpy()]))
        whole = np.concatenate([[0], np.cumsum(lists.flatten().to_numpy().astype(np.int64))])
        bucket = whole[1:] - np.repeat(whole[ends[:-1]], np.diff(ends))
        total += np.bincount(bucket, minlength=BUCKETS)
        toxic += np.bincount(bucket, weights=np.repeat(label, np.diff(ends)), minlength=BUCKETS).astype(np.int64)
        n, n_toxic = n + len(label), n_toxic + int(label.sum())
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n)), pa.array(np.append(toxic[at], n_toxic))],
                                     ["bucket", "n", "toxic"])


def _bags(chosen: np.ndarray):
    """Chosen words of each document with their sentences, and how many sentences it has."""

    def run(batches):
        number = np.full(BUCKETS, -1)
        number[chosen] = np.arange(len(chosen))
        for batch in slices(batches):
            _, _, w, bucket, head, sentence = _sentences(batch.column("text"))
            many = sums(head, w.bounds).astype(np.int64)
            of, once = _once(sentence, bucket)
            word = number[once]
            of, word = of[word >= 0], word[word >= 0]
            before = np.concatenate([[0], np.cumsum(many)])
            ends = np.searchsorted(of, before)
            out = []
            for i in range(batch.num_rows):
                at = slice(ends[i], ends[i + 1])
                out.append(np.stack([of[at] - before[i], word[at]]).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.maximum(many, 1)), pa.array(out, pa.binary())], ["doc_id", "sentences", "bag"])

    return run


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> ToxicModel:
    """Train on rows of ``labels`` (``doc_id``, ``toxic`` 0 or 1) that are not held out."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marks = settled(marks, "toxic-marks")
    sets = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select(F.col("doc_id").cast("long"), "text").mapInArrow(_bucket_sets, "doc_id long, steps array<int>")
    # shuffled at every size, as the labels grow with the documents; a label may stand for several rows of an id
    counted = sets.hint("merge").join(marks, F.col("doc_id") == F.col("__id")).select("steps", "toxic").mapInArrow(_word_counts, "bucket long, n long, toxic long")
    counts = settled(counted.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")), "word-counts")
    # max_train pairs, half of each label if there are so many
    many = {bool(r.toxic): r.n for r in marks.groupBy(F.col("toxic") > 0).agg(F.count("*").alias("n"), F.max("toxic").alias("toxic")).collect()}
    take = {True: min(many.get(True, 0), max(max_train // 2, max_train - many.get(False, 0)))}
    take[False] = min(many.get(False, 0), max_train - take[True])
    known = {r["__id"]: r.toxic for k, n in take.items() for r in marks.where((F.col("toxic") > 0) == k).orderBy(F.xxhash64("__id"), "__id").limit(n).collect()}
    sample = docs.sparkSession.createDataFrame(list(known.items()), "__id long, toxic int")
    picked = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), F.col("doc_id") == F.col("__id"))
    whole = counts.where("bucket = -1").first()
    share = whole.toxic / whole.n if whole and whole.n else 0.0
    if not 0 < share < 1:
        return ToxicModel(np.zeros(BUCKETS), 0.0, share)
    lean = (F.col("toxic") - F.col("n") * F.lit(share)) / F.sqrt(F.col("n") * F.lit(share * (1 - share)))
    # VOCABULARY buckets
    best = counts.where(f"bucket >= 0 and n >= {LEAST_DOCS}").where(F.abs(lean) >= LEAST_LEAN).orderBy(F.desc(F.abs(lean)), "bucket").limit(VOCABULARY).select("bucket").collect()
    chosen = np.array(sorted(r.bucket for r in best), dtype=np.int64)
    bags = picked.select("doc_id", "text").mapInArrow(_bags(chosen), "doc_id long, sentences long, bag binary").dropDuplicates(["doc_id"])
    got = sorted(bags.collect(), key=lambda r: r.doc_id)
    if not got or not len(chosen):
        return ToxicModel(np.zeros(BUCKETS), 0.0, share)
    sentences, y_of, owner_of = np.array([r.sentences for r in got]), [r.doc_id for r in got], np.array([len(r.bag) // 8 for r in got])
    bags = [np.frombuffer(r.bag, dtype="<i4").reshape(2, -1) for r in got]
    del got
    word = np.concatenate([b[1] for b in bags]).astype(np.int64)
    place = np.concatenate([b[0] for b in bags])  # rises in each document
    del bags
    doc = np.repeat(np.arange(len(owner_of), dtype=np.int32), owner_of)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])
    sentence, owner = np.cumsum(new) - 1, doc[new].astype(np.int64)
    blank = sentences - np.bincount(owner, minlength=len(sentences))
    del doc, place, new
    y = np.array([known[i] for i in y_of], dtype=float)
    counts_for = np.where(y > 0, many.get(True, 0) / max(take[True], 1), many.get(False, 0) / max(take[False], 1))
    weights, bias = _fit(sentence, word, owner, blank, y, len(chosen), counts_for / counts_for.mean())
    spread = np.zeros(BUCKETS)
    spread[chosen] = weights
    return ToxicModel(spread, bias)


def _fit(sentence, word, owner, blank, y, size, weight=None) -> tuple[np.ndarray, float]:
    """Adam on the mean noisy-or log loss. ``owner``: document of each sentence that has words; ``blank``: sentences without;
    ``weight``: what each document counts for, 1 on average."""
    n = len(y)
    weight = np.ones(n) if weight is None else weight
    p = np.zeros(size + 1)
    p[-1] = np.log(max((weight * y).mean(), 1e-3) / max(np.mean(blank) + len(owner) / n, 1))
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, EPOCHS + 1):
        z = np.bincount(sentence, weights=p[word], minlength=len(owner)) + p[-1]
        clean = -(np.bincount(owner, weights=_softplus(z), minlength=n) + blank * _softplus(p[-1]))  # log P(not toxic)
        prob = np.clip(-np.expm1(clean), 1e-9, 1 - 1e-9)
        slope = weight * np.where(y > 0, -(1 - prob) / prob, 1.0) / n  # by the sum of softplus
        ds = slope[owner] * _sigmoid(z)
        g = np.zeros_like(p)
        g[:-1] = np.bincount(word, weights=ds[sentence], minlength=size)[:size] + RIDGE / n * p[:-1]
        g[-1] = ds.sum() + (slope * blank).sum() * _sigmoid(p[-1])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return p[:-1], float(p[-1])


def toxicity(docs: DataFrame, model: ToxicModel, limit: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``n_sentences``, ``worst_start``, ``worst_end``, ``worst_score``, ``offending``.

    Of the worst sentence the code points from its first word to after its last one; ``offending`` lists start:end of the
    sentences with ``SENTENCE_LIMIT`` or more. Documents without words have no worst sentence.
    """
    weights, bias, constant = model.weights, model.bias, model.constant

    def run(batches):
        for batch in slices(batches):
            data, offsets, w, bucket, head, sentence = _sentences(batch.column("text"))
            at = np.flatnonzero(head)
            of, once = _once(sentence, bucket)
            z = np.bincount(of, weights=weights[once], minlength=len(at)) + bias if len(at) else np.zeros(0)
            bounds = np.concatenate([[0], np.cumsum(head)])[w.bounds]
            many = np.diff(bounds)
            clean = sums(_softplus(z), bounds) + (many == 0) * _softplus(bias)
            score = -np.expm1(-clean) if constant is None else np.full(batch.num_rows, constant)
            own = _sigmoid(z) if constant is None else np.full(len(z), constant)
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            last = (np.append(at[1:], len(w.doc)) - 1)[:len(at)]
            start, end = points[w.starts[at]], points[w.ends[last]]
            worst, offending = [], []
            for i in range(batch.num_rows):
                a, b = bounds[i], bounds[i + 1]
                base = points[offsets[i]]
                if a == b:
                    worst.append((None, None, None))
                    offending.append("")
                    continue
                k = a + int(np.argmax(own[a:b]))
                worst.append((int(start[k] - base), int(end[k] - base), float(own[k])))
                offending.append(",".join(f"{start[j] - base}:{end[j] - base}" for j in a + np.flatnonzero(own[a:b] >= SENTENCE_LIMIT)))
            score = np.clip(score, 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= limit).astype(np.int32)),
                                              pa.array(np.maximum(many, 1), pa.int64()), *(pa.array([x[c] for x in worst], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))),
                                              pa.array(offending, pa.string())],
                                             ["doc_id", "held_out", "score", "predicted", "n_sentences", "worst_start", "worst_end", "worst_score", "offending"])

    own = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return own.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_sentences long, worst_start long, worst_end long, worst_score double, offending string")
