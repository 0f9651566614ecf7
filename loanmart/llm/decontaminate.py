"""Benchmark passages in training documents: rare word pairs as seeds, then Smith-Waterman alignment of words.

Method: neighbouring words of an item are a pair, and a document has it if at most ``ADDED`` words stand between the two.
A copy that reaches ``min_score`` lacks a bounded number of the item's pairs (``_seeds_needed``), so one more than that
number, the item's rarest in the corpus, are its seeds: each such copy has one of them. An item too short for the bound
is found by its rarest words in the same way. Each document pass drops pairs that no test item can have by a bit table of
fixed size (1 MB); what stays is joined exactly: the first pass counts pairs, the second takes the passages around seeds,
with a table for each doubling of the items' lengths (at most some twenty), so that a passage is as wide as its own items ask.
Seeds of a document and an item on neighbouring diagonals mark a window that reaches as many words further on both sides
as a copy at the limit may have added, so it holds the whole of each copy that one of its seeds is in. The window is
aligned with the item: +1 for an equal word, -1/4 for a changed, left out or added one. ``score`` is the best local score
by the item's words, and of the places with this score the last is named. Four of five words equal, the others changed,
give 0.75, the default limit. ``seeds`` counts the document's hits of the item's seeds.

Defined cases: words are runs of 0-9, A-Z (as a-z) and characters beyond ASCII. Documents or items without words match
nothing; null texts are empty. An item of one word is found by it. Items equal in words are one item,
named by the smallest id, with ``n_items`` of them; the name is null if none has an id. An id with several texts is several
items and may have a row for each. A row with a null ``doc_id`` matches like any other.
Every input row is a document; rows that repeat an id or text give a row each. Other columns are not read. Empty tables
give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmart.llm.columns import free
from loanmart.llm.text import Words, mixed, raw, slices, word_codes, words
from loanmart.session import settled

MIN_SCORE = 0.75
COST = 0.25
#: Words that a document may have between the two words of a pair.
ADDED = 2
#: Bits of the table that pairs of documents are looked up in: the same at every size.
BITS = 1 << 23
#: Parts of a pair's hash, by shift, that must all be in the table.
PROBES = (0, 32)

_ITEMS = "item_id long, words array<long>, n int"
_PASSAGES = "doc_id long, row long, t1 long, t2 long, first int, words array<long>, at array<int>, gram array<long>"


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _item_words(batches):
    codes = word_codes()
    for batch in slices(batches):
        w = words(*raw(batch.column("text")), codes)
        lists = pa.ListArray.from_arrays(pa.array(w.bounds, pa.int32()), pa.array(_signed(w.hash)))
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), lists, pa.array(w.counts, pa.int32())], ["item_id", "words", "n"])


def _runs(w: Words, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every two words of one text that stand ``apart``; of every word for 0."""
    n = max(len(w.doc) - apart, 0)
    if not apart:
        return np.arange(n), mixed(w.hash + np.uint64(1))
    first = np.flatnonzero(w.doc[:n] == w.doc[apart:])
    return first, mixed(mixed(w.hash[first] + np.uint64(2)) + w.hash[first + apart])


def _seeds_needed(n: int, min_score: float) -> tuple[bool, int]:
    """Whether an item of ``n`` words is found by pairs (else by words), and by how many of them.

    A score of ``min_score`` leaves ``n * (1 - min_score)`` to lose. A word that is changed or left out costs 1 + COST and
    breaks two pairs, one missing at an end costs 1 and breaks one; ADDED + 1 words added in a pair break it.
    """
    lost = n * (1 - min_score) + 1e-9
    broken = int(lost / min((1 + COST) / 2, COST * (ADDED + 1), 1.0))
    return (True, broken + 1) if broken + 1 <= n - 1 else (False, min(int(lost) + 1, n))


def _most_added(n, min_score: float):
    """Words that a copy of an item of ``n`` words may have added and still score ``min_score``; a number or a Column."""
    return n * ((1 - min_score) / COST) + 1e-9


def _item_grams(min_score: float):
    def run(batches):
        for batch in batches:
            item, at, gram, need, pair = [], [], [], [], []
            for i, row in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist()):
                by_pairs, k = _seeds_needed(len(row), min_score)
                first, h = _runs(_as_words(np.array(row, dtype=np.int64)), int(by_pairs))
                item += [i] * len(first)
                at += first.tolist()
                gram += _signed(h).tolist()
                need += [k] * len(first)
                pair += [by_pairs] * len(first)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(at, pa.int32()), pa.array(gram, pa.int64()), pa.array(need, pa.int32()),
                                              pa.array(pair, pa.bool_())], ["item", "ipos", "gram", "need", "pair"])

    return run


def _as_words(h: np.ndarray):
    zero = np.zeros(len(h), dtype=np.int64)
    return Words(zero, zero, zero, h.view(np.uint64), np.array([0, len(h)]))


def _known(w: Words, tables: list[tuple[np.ndarray, int]], apart: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the first word and hash of the pairs (words for 0) that a bit table knows, in order, with the largest
    number that stands beside such a table."""
    at, gram, number = [], [], []
    for k in apart:
        first, h = _runs(w, k)
        most = np.full(len(h), -1, dtype=np.int64)
        for bits, own in tables:
            hit = np.ones(len(h), dtype=bool)
            for shift in PROBES:
                place = ((h >> np.uint64(shift)) & np.uint64(BITS - 1)).astype(np.int64)
                hit &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            most[hit] = np.maximum(most[hit], own)
        hit = most >= 0
        at.append(first[hit])
        gram.append(h[hit])
        number.append(most[hit])
    at, gram, number = np.concatenate(at), np.concatenate(gram), np.concatenate(number)
    order = np.argsort(at, kind="stable")
    return at[order], gram[order], number[order]


def _counts(table, apart: list[int]):
    def run(batches):
        codes, bits = word_codes(), np.frombuffer(table.value, dtype=np.uint8)
        for batch in slices(batches):
            gram, n = np.unique(_known(words(*raw(batch.column("text")), codes), [(bits, 0)], apart)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(gram)), pa.array(n, pa.int64())], ["gram", "df"])

    return run


def _bit_table(grams: DataFrame):
    """Broadcast table of the hashes ``gram``; at most BITS / 32 rows are collected, whatever the size of the benchmark."""
    probes = ", ".join(f"shiftrightunsigned(gram, {shift}) & {BITS - 1}" for shift in PROBES)
    lanes = grams.select(F.expr(f"explode(array({probes}))").alias("at")).groupBy(F.expr("cast(at >> 5 as int)").alias("lane")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 31 as int)))").alias("bits"))
    bits = np.zeros(BITS // 32, dtype="<u4")
    for lane, value in lanes.collect():
        bits[lane] = value
    return grams.sparkSession.sparkContext.broadcast(bits.tobytes())


def _passages(tables: list[tuple], apart: list[int]):
    """Runs of words around seeds that a bit table knows, as far as the margin that stands beside it; what overlaps is one."""

    def run(batches):
        codes, read = word_codes(), [(np.frombuffer(t.value, dtype=np.uint8), margin) for t, margin in tables]
        for batch in slices(batches):
            w = words(*raw(batch.column("text")), codes)
            at, gram, margin = _known(w, read, apart)
            if not len(at):
                continue
            doc = w.doc[at]
            left, right = np.maximum(at - margin, w.bounds[doc]), np.minimum(at + margin, w.bounds[doc + 1])
            # by where they begin; a seed opens a passage if all before it end earlier
            order = np.argsort(left, kind="stable")
            at, gram, doc, left, right = (x[order] for x in (at, gram, doc, left, right))
            new = np.ones(len(at), dtype=bool)
            new[1:] = left[1:] >= np.maximum.accumulate(right)[:-1]
            cuts = np.append(np.flatnonzero(new), len(at))
            owner, low, high = doc[cuts[:-1]], left[cuts[:-1]], np.maximum.reduceat(right, cuts[:-1])
            base = w.bounds[owner]
            runs = [_signed(w.hash[a:b]) for a, b in zip(low, high)]
            ends = np.concatenate([[0], np.cumsum(high - low)])
            of = np.repeat(np.arange(len(owner)), np.diff(cuts))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c).take(pa.array(owner)) for c in ("doc_id", "row", "t1", "t2")), pa.array(low - base, pa.int32()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(runs))),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(at - low[of], pa.int32())),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(_signed(gram)))],
                ["doc_id", "row", "t1", "t2", "first", "words", "at", "gram"])

    return run


def smith_waterman(item: np.ndarray, windows: np.ndarray, cost: float = COST) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of ``item`` with each row of ``windows``, and the column after its end, the last of several."""
    n, width = windows.shape
    above, best, end = np.zeros((n, width + 1)), np.zeros(n), np.zeros(n, dtype=np.int64)
    drop = cost * np.arange(width + 1)
    for word in item:
        row = np.zeros((n, width + 1))
        np.maximum(above[:, :-1] + np.where(windows == word, 1.0, -cost), above[:, 1:] - cost, out=row[:, 1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + drop, axis=1) - drop  # gaps along the window
        top = width - row[:, ::-1].argmax(axis=1)
        value = row[np.arange(n), top]
        better = (value > best) | ((value == best) & (top > end) & (value > 0))
        best[better], end[better] = value[better], top[better]
        above = row
    return best, end


def _aligned(batches):
    """Score each window (``words``, from word ``first`` of the document) with its item; windows of an item are aligned together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        item = batch.column("item").to_numpy()
        lists, tests = batch.column("words"), batch.column("item_words")
        held, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        score, end = np.zeros(len(item)), np.zeros(len(item), dtype=np.int64)
        for i in np.unique(item):
            at = np.flatnonzero(item == i)
            test = np.array(tests[int(at[0])].as_py(), dtype=np.int64)
            # the fill must not be a word: it is unequal to every word of the item
            fill = next(x for x in range(len(test) + 1) if x not in set(test.tolist()))
            for part in np.array_split(at, len(at) * int(np.diff(ends)[at].max()) // 200_000 + 1):
                grid = np.full((len(part), int(np.diff(ends)[part].max(initial=0))), fill, dtype=np.int64)
                for g, r in zip(grid, part):
                    g[:ends[r + 1] - ends[r]] = held[ends[r]:ends[r + 1]]
                best, stop = smith_waterman(test, grid)
                score[part], end[part] = best / len(test), stop
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "row", "item", "item_id")), pa.array(score),
                                          pa.array(end + batch.column("first").to_numpy(), pa.int64()), batch.column("seeds"), batch.column("n_items")],
                                         ["doc_id", "row", "item", "item_id", "score", "end_word", "seeds", "n_items"])


def benchmark_matches(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id``, ``item_id``, ``score``, ``end_word`` (word of the document after the best match), ``seeds``, ``n_items``, ``row``, ``t1``, ``t2`` (the text's hashes).

    One row for each document row (``row`` tells rows apart) and item that align with ``min_score`` or more.
    """
    read = items.select(F.col("item_id").cast("long"), "text").mapInArrow(_item_words, _ITEMS).where("n > 0")
    texts = read.groupBy("words", "n").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"))
    # ids may be null or repeated: each text has a number of its own
    tests = settled(texts.withColumn("item", F.monotonically_increasing_id()), "items")
    grams = settled(tests.select("item", "words").mapInArrow(_item_grams(min_score), "item long, ipos int, gram long, need int, pair boolean"), "item-grams")
    kinds = {r.pair for r in grams.select("pair").distinct().collect()}
    apart = [0] * (kinds != {True}) + list(range(1, ADDED + 2)) * (True in kinds)
    seen = docs.select("text").mapInArrow(_counts(_bit_table(grams), apart), "gram long, df long").groupBy("gram").agg(F.sum("df").alias("df"))
    order = Window.partitionBy("item").orderBy(F.coalesce("df", F.lit(0)), "gram", "ipos")
    rated = grams.join(seen, "gram", "left").withColumn("rank", F.row_number().over(order))
    rare = settled(rated.where("rank <= need").select("gram", "item", "ipos"), "seeds")
    rows = docs.select(F.col("doc_id").cast("long"), "text", *_digests(), F.monotonically_increasing_id().alias("row"))
    # a table for each doubling of the items' lengths: a long item widens the passages of its own seeds only
    lengths = tests.select("item", F.ceil(F.log2("n")).cast("int").alias("size"))
    of_size = settled(rare.join(lengths, "item").select("gram", "size"), "seed-sizes")
    sizes = sorted(r["size"] for r in of_size.select("size").distinct().collect())
    tables = [(_bit_table(of_size.where(F.col("size") == c).select("gram")), (1 << c) + int(_most_added(1 << c, min_score))) for c in sizes]
    passages = settled(rows.mapInArrow(_passages(tables, apart), _PASSAGES)
                       .withColumn("pid", F.monotonically_increasing_id()), "passages")
    hits = passages.select("pid", F.explode(F.arrays_zip("at", "gram")).alias("x")).select("pid", "x.at", "x.gram")
    sized = tests.select("item", "item_id", "n", F.col("words").alias("item_words"), "n_items")
    met = hits.join(rare, "gram").join(sized.select("item", "n"), "item")
    band = F.floor((F.col("at") - F.col("ipos")) / F.col("n")).cast("int")
    marks = met.groupBy("pid", "item", "n", band.alias("band")).agg(F.count("*").alias("seeds"), F.min(F.col("at") - F.col("ipos")).alias("d1"),
                                                                   F.max(F.col("at") - F.col("ipos")).alias("d2"))
    slack = F.floor(_most_added(F.col("n"), min_score)).cast("int")
    windows = marks.select("pid", "item", "seeds", (F.col("d1") - slack).alias("low"), (F.col("d2") + F.col("n") + slack).alias("high"))
    # each window takes its own words along, so a passage of many windows is not repeated whole
    low = F.greatest("low", F.lit(0))
    cut = windows.join(passages.select("pid", "doc_id", "row", "first", "words"), "pid").select(
        "doc_id", "row", "item", (F.col("first") + low).alias("first"), F.slice("words", low + 1, F.col("high") - low).alias("words"), "seeds")
    scored = cut.join(sized.drop("n"), "item").select("doc_id", "row", "item", "item_id", "first", "words", "item_words", "seeds", "n_items").mapInArrow(
        _aligned, "doc_id long, row long, item long, item_id long, score double, end_word long, seeds long, n_items long")
    best = scored.groupBy("row", "item").agg(
        F.max(F.struct("score", "end_word")).alias("b"), F.sum("seeds").alias("seeds"), F.max("n_items").alias("n_items"), F.max("doc_id").alias("doc_id"),
        F.max("item_id").alias("item_id")).where(F.col("b.score") >= min_score)
    texts = passages.select("row", "t1", "t2").distinct()
    return best.join(texts, "row").select("doc_id", "item_id", "b.score", "b.end_word", "seeds", "n_items", "row", "t1", "t2")


def _digests():
    return F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")


def without_matches(docs: DataFrame, found: DataFrame, null_ids_stay: bool = True) -> DataFrame:
    """Rows of ``docs`` whose id and text have no match; rows with a null id stay unless ``null_ids_stay`` is false."""
    hit = found.where("doc_id is not null") if null_ids_stay else found
    i, b1, b2 = free(docs.columns, "__id", "__b1", "__b2")
    hit = hit.select(F.col("doc_id").alias(i), F.col("t1").alias(b1), F.col("t2").alias(b2)).distinct()
    t1, t2 = _digests()
    return docs.join(hit, F.col("doc_id").cast("long").eqNullSafe(F.col(i)) & (t1 == F.col(b1)) & (t2 == F.col(b2)), "left_anti")
