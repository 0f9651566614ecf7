"""Tokens of two vocabularies side by side: groups that end at the same byte, and how often id pairs meet in one.

Method: divide and conquer at shared cuts. Both token sequences of a text are taken as their ends in bytes. Of an interval
between two cuts the end of a first token near the middle is looked up among the second ends by bisect; where it is
shared, it cuts the interval and both halves go on; otherwise the next end, outward from the middle, is tried. An interval
without a shared end inside is a leaf: one group. All intervals of many texts take each step together, as arrays.

Pairs: all first and second ids of a group are linked. A pair counts the texts that hold it linked, over the whole table.
Texts are dealt into blocks of bounded bytes; a block hands in each of its pairs once, so a pair that every text holds
comes once for a block, not once for a text. Totals come back to the blocks in the same form, and each block settles
its texts.

Texts: the first vocabulary reads a space and the text, the second the text, to which it adds a space itself. Defined
cases: a null or empty text, and one whose tokens' bytes are not a space and the text in either vocabulary (a text with
U+2581, say), has no tokens: all counts 0, ``groups`` empty. Names of special tokens inside texts are plain text. All
other columns stay; the new columns must not be there yet (``ValueError``). Repeated rows are texts of their own. No
rows give no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.llm.text import slices
from loanmart.session import settled

#: Bytes of text in a block, unless one text alone has more.
BLOCK_BYTES = 4 << 20
#: Set in the ids of the second vocabulary where both stand in one record.
SECOND = 1 << 31
#: Tries next to the middle before all ends of an interval are looked up at once.
TRIES = 24
#: Links of a group that are written out one by one; of larger groups, distinct ids are paired.
PLAIN_LINKS = 4096


def _letters() -> dict[str, int]:
    """Byte for each letter by which byte-level vocabularies write bytes: visible ones as themselves, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


#: A space between two visible characters. No token of either kind runs across one, so the words between are encoded apart.
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Words up to so many characters, and so many of them in each of two generations, are remembered in a task.
REMEMBERED_CHARS, REMEMBERED = 64, 250_000


class ByteLevel:
    """A byte-level vocabulary given as the JSON text of its file."""

    def __init__(self, source: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks
        from tokenizers import Tokenizer

        letters = _letters()
        self.model = Tokenizer.from_str(source)
        self.apart = self.in_line = True  # the cutting pattern begins a new part at such a space
        self.model.encode_special_tokens = True
        ids = json.loads(source)["model"]["vocab"]
        self.pieces = [b""] * (max(ids.values(), default=-1) + 1)
        for token, i in ids.items():
            self.pieces[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """A vocabulary of pieces with byte fallback, given as the bytes of its file."""

    def __init__(self, source: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=source)
        self.pieces = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.pieces.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        self.in_line = False  # a long line costs it more than its words
        self.apart = not any(re.search("[^▁]▁", self.model.id_to_piece(i)) for i in range(len(self.pieces)))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def shared_cuts(a: np.ndarray, b: np.ndarray, a_from: np.ndarray, a_to: np.ndarray, b_from: np.ndarray, b_to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the ends in ``a`` and in ``b`` that both have, for intervals of tokens whose last ends are shared.

    ``a`` and ``b`` rise throughout; interval i has the tokens ``a_from[i]:a_to[i]`` and ``b_from[i]:b_to[i]``.
    """
    cut_a, cut_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
    cut_a[a_to - 1] = cut_b[b_to - 1] = True
    tried = np.zeros(len(a_from), dtype=np.int64)
    while True:
        # an interval with one token on a side, or with all its ends tried, is a leaf
        open_ = (a_to - a_from - 1 > tried) & (b_to - b_from > 1)
        a_from, a_to, b_from, b_to, tried = (x[open_] for x in (a_from, a_to, b_from, b_to, tried))
        if not len(a_from):
            return cut_a, cut_b
        step = (tried + 1) // 2
        k = a_from + (a_to - a_from - 2) // 2 + np.where(tried % 2, step, -step)
        j = np.searchsorted(b, a[k])
        hit = (j < b_to - 1) & (b[np.minimum(j, len(b) - 1)] == a[k])
        for i in np.flatnonzero(~hit & (tried >= TRIES)):
            # far from the middle: all ends of the interval at once
            ends = np.arange(a_from[i], a_to[i] - 1)
            at = np.searchsorted(b, a[ends])
            found = np.flatnonzero((at < b_to[i] - 1) & (b[np.minimum(at, len(b) - 1)] == a[ends]))
            if len(found):
                nearest = found[np.argmin(np.abs(ends[found] - k[i]))]
                k[i], j[i], hit[i] = ends[nearest], at[nearest], True
            else:
                tried[i] = a_to[i] - a_from[i]
        cut_a[k[hit]] = cut_b[j[hit]] = True
        # a hit gives two intervals in its place, so that all stay in order and lookups near each other
        of = np.repeat(np.arange(len(hit)), 1 + hit)
        right = np.zeros(len(of), dtype=bool)
        right[1:] = of[1:] == of[:-1]
        left = hit[of] & ~right
        a_from, a_to = np.where(right, k[of] + 1, a_from[of]), np.where(left, k[of] + 1, a_to[of])
        b_from, b_to = np.where(right, j[of] + 1, b_from[of]), np.where(left, j[of] + 1, b_to[of])
        tried = np.where(hit[of], 0, tried[of] + 1)


def _expanded(a, b, a_at, p, b_at, q, doc):
    """Text, first and second id of each link of groups of ``p`` first tokens from ``a_at`` and ``q`` second ones from ``b_at``."""
    many = p * q
    g = np.repeat(np.arange(len(many)), many)
    place = np.arange(len(g)) - np.repeat(np.cumsum(many) - many, many)
    return doc[g], a[a_at[g] + place // q[g]], b[b_at[g] + place % q[g]]


def links(a, b, a_at, p, b_at, q, doc, base: int):
    """Text, pair (first id times ``base`` and second id) and times, sorted, each pair of a text once."""
    key = lambda d, x, y: (d.astype(np.int64) << 32) | (x.astype(np.int64) * base + y)
    plain = p * q <= PLAIN_LINKS
    keys, times = np.unique(key(*_expanded(a, b, a_at[plain], p[plain], b_at[plain], q[plain], doc[plain])), return_counts=True)
    parts = [(keys, times)]
    for i in np.flatnonzero(~plain):
        x, m = np.unique(a[a_at[i]:a_at[i] + p[i]], return_counts=True)
        y, n = np.unique(b[b_at[i]:b_at[i] + q[i]], return_counts=True)
        parts.append((key(np.full(len(x) * len(y), doc[i]), np.repeat(x, len(y)), np.tile(y, len(x))), np.outer(m, n).ravel()))
    if len(parts) > 1:
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        total = np.zeros(len(keys), dtype=np.int64)
        np.add.at(total, at, np.concatenate([t for _, t in parts]))
        times = total
    return keys >> 32, keys & 0xFFFFFFFF, times


class _Aligner:
    """Groups and links of many texts at once."""

    def __init__(self, left, right):
        self.left, self.right, self.base = left, right, len(right.pieces)
        self.sizes = [np.array([len(x) for x in v.pieces], dtype=np.int64) for v in (left, right)]
        # words met lately; what is not met again while a generation fills up goes with the next one
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.odd: set[str] = set()
        # what a token is written as: first of all, first of a group, a later one, first of a group's second ones
        self.first = len(left.pieces)
        self.written = [f"{mark}{i}" for mark in (";", ",") for i in range(len(left.pieces))] + [f"{mark}{i}" for mark in ("|", ",") for i in range(self.base)]

    def _read(self, words: list[str], one_line: bool) -> None:
        """Remember the tokens of texts: the first ones' ids and the second ones' with ``SECOND`` set, four bytes each; and
        which texts have other bytes than a space and the text."""
        if not words:
            return
        whole = [(" " + w).encode("utf-8", "replace") for w in words]
        line, sizes = b"".join(whole), np.array([len(x) for x in whole])
        sides = []
        for v, size, mark in zip((self.left, self.right), self.sizes, (0, SECOND)):
            ids, stops = self._in_line(v, size, words, sizes) if one_line and v.in_line and v.apart else (None, None)
            if ids is None:
                made = v.encode(words)
                stops = np.cumsum([len(x) for x in made])
                ids = np.fromiter(chain.from_iterable(made), dtype=np.int64, count=int(stops[-1]))
            ends = np.concatenate([[0], np.cumsum(size[ids])])[stops]
            if not np.array_equal(ends, np.cumsum(sizes)) or b"".join(map(v.pieces.__getitem__, ids.tolist())) != line:
                pieces = [v.pieces[i] for i in ids.tolist()]
                self.odd.update(w for w, x, lo, hi in zip(words, whole, [0, *stops], stops) if b"".join(pieces[lo:hi]) != x)
            cuts = (4 * stops).tolist()
            sides.append(map((ids | mark).astype(np.uint32).tobytes().__getitem__, map(slice, [0, *cuts], cuts)))
        self.known.update(zip(words, map(add, *sides)))

    def _in_line(self, v, size: np.ndarray, words: list[str], sizes: np.ndarray):
        """Ids of words that are encoded as one line, and how many there are up to each word's end; None where no token ends there."""
        ids = np.array(v.encode([" ".join(words)])[0], dtype=np.int64)
        stop, ends = np.cumsum(size[ids]), np.cumsum(sizes)
        at = np.minimum(np.searchsorted(stop, ends), len(ids) - 1)
        return (ids, at + 1) if np.array_equal(stop[at], ends) else (None, None)

    def ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Token ids and numbers of tokens, for both sides; no tokens for a text whose bytes differ."""
        cut = [(BETWEEN.split(t) if self.left.apart and self.right.apart else [t]) if t else [] for t in texts]
        missing = []
        for w in set(chain.from_iterable(cut)).difference(self.known):
            if (old := self.older.get(w)) is not None:
                self.known[w] = old
            else:
                missing.append(w)
        # words with blanks at an end, which only a text's first and last can have, stand in no line
        edges = {w for words in cut if words for w in (words[0], words[-1]) if w[0].isspace() or w[-1].isspace()}
        self._read([w for w in missing if w not in edges], True)
        self._read([w for w in missing if w in edges], False)
        records = [b"".join(map(self.known.__getitem__, words)) for words in cut]
        for i, words in enumerate(cut):
            # bytes that differ in a word might still make up the text
            if self.odd and not self.odd.isdisjoint(words):
                ids, whole = np.frombuffer(records[i], dtype=np.uint32), (" " + texts[i]).encode("utf-8", "replace")
                own = ids[ids < SECOND], ids[ids >= SECOND] - SECOND
                if any(b"".join([v.pieces[k] for k in side]) != whole for v, side in zip((self.left, self.right), own)):
                    records[i] = b""
        for w in [w for w in missing if len(w) > REMEMBERED_CHARS]:
            del self.known[w]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
            self.odd &= self.older.keys()
        ids = np.frombuffer(b"".join(records), dtype=np.uint32).astype(np.int64)
        second = ids >= SECOND
        upto = np.concatenate([[0], np.cumsum(second)])[np.concatenate([[0], np.cumsum([len(r) // 4 for r in records])]).astype(np.int64)]
        n_b = np.diff(upto)
        n_a = np.array([len(r) // 4 for r in records], dtype=np.int64) - n_b
        return [ids[~second], ids[second] - SECOND], [n_a, n_b]

    def align(self, texts: list[str]) -> dict:
        tokens, counts = self.ids(texts)
        bounds = [np.concatenate([[0], np.cumsum(n)]) for n in counts]
        ends = [np.cumsum(size[t]) for size, t in zip(self.sizes, tokens)]
        some = np.flatnonzero(counts[0])
        cuts = shared_cuts(*ends, bounds[0][some], bounds[0][some + 1], bounds[1][some], bounds[1][some + 1])
        stop = [np.flatnonzero(c) + 1 for c in cuts]
        at = [np.concatenate([[0], s[:-1]]) if len(s) else s for s in stop]
        p, q = stop[0] - at[0], stop[1] - at[1]
        doc = np.searchsorted(bounds[0], at[0], side="right") - 1
        n_groups = np.bincount(doc, minlength=len(texts))
        n_links = np.zeros(len(texts), dtype=np.int64)
        np.add.at(n_links, doc, p * q)
        of, pair, times = links(tokens[0], tokens[1], at[0], p, at[1], q, doc, self.base)
        return {"n_a": counts[0], "n_b": counts[1], "n_groups": n_groups, "n_links": n_links, "groups": self._text(tokens, at, p, q, bounds, n_groups),
                "pair_bounds": np.searchsorted(of, np.arange(len(texts) + 1)), "pairs": pair, "times": times}

    def _text(self, tokens, at, p, q, bounds, n_groups) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each text."""
        start = np.cumsum(p + q) - p - q
        codes = np.empty(len(tokens[0]) + len(tokens[1]), dtype=np.int64)
        for ids, begin, n, place, low, size in ((tokens[0], at[0], p, start, 0, self.first), (tokens[1], at[1], q, start + p, 2 * self.first, self.base)):
            lead = np.zeros(len(ids), dtype=bool)
            lead[begin] = True
            codes[np.arange(len(ids)) + np.repeat(place - begin, n)] = low + np.where(lead, 0, size) + ids
        codes, out = codes.tolist(), []
        for lo, hi in zip(bounds[0] + bounds[1], (bounds[0] + bounds[1])[1:]):
            out.append("".join(map(self.written.__getitem__, codes[lo:hi]))[1:])
        return out


#: By the files' digests: a worker's next task finds the vocabularies read and words known.
_READY: dict[bytes, _Aligner] = {}


def _aligner(left: str, right: bytes) -> _Aligner:
    key = hashlib.sha256(left.encode() + right).digest()
    if key not in _READY:
        _READY.clear()
        _READY[key] = _Aligner(ByteLevel(left), Pieces(right))
    return _READY[key]


def _broadcast(spark, left, right):
    """Both files' contents; their size is that of the vocabularies."""
    with open(left, encoding="utf-8") as a, open(right, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


_LONGS = ("n_a", "n_b", "n_groups", "n_links")


def aligned(docs: DataFrame, left: str, right: str, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (ids as ``a1,a2|b1;a3|b2,b3``), and for
    :func:`counted` ``block``, ``pairs``, ``times``; ``left`` is the file of a byte-level vocabulary, ``right`` that of a piece vocabulary."""
    made = [*_LONGS, "groups", "block", "pairs", "times"]
    if clash := {c.lower() for c in docs.columns} & set(made):
        raise ValueError(f"there are columns {sorted(clash)} already")
    files = _broadcast(docs.sparkSession, left, right)

    def work(batches):
        aligner = _aligner(*files.value)
        block, inside = TaskContext.get().partitionId() << 32, 0
        for batch in slices(batches, text):
            texts = batch.column(text).to_pylist()
            size = sum(len(t) for t in texts if t)
            if inside and inside + size > block_bytes:
                block, inside = block + 1, 0
            inside += size
            x = aligner.align([t or "" for t in texts])
            ends = pa.array(x["pair_bounds"], pa.int32())
            new = [*(pa.array(x[c], pa.int64()) for c in _LONGS), pa.array(x["groups"], pa.string()), pa.array(np.full(len(texts), block), pa.int64()),
                   pa.ListArray.from_arrays(ends, pa.array(x["pairs"].astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(x["times"], pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *made])

    kinds = ["long"] * 4 + ["string", "long", "array<int>", "array<long>"]
    added = T.StructType([T.StructField(c, T._parse_datatype_string(k)) for c, k in zip(made, kinds)])
    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, *added.fields]))


def _handed_in(batches):
    """Each pair of a run of rows of one block once, with the number of rows."""
    held, block = [], None

    def out():
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), block), pa.int64()), pa.array(pair.astype(np.int32)), pa.array(n, pa.int64())], ["block", "pair", "n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        of = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1), len(of)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and of[lo] != block:
                yield out()
                held = []
            block = of[lo]
            held.append(batch.column("pairs").slice(lo, hi - lo).flatten().to_numpy())
    if held:
        yield out()


def pair_counts(found: DataFrame, base: int) -> tuple[DataFrame, DataFrame]:
    """Blocks' pairs ``block``, ``pair``; and ``pair``, ``count`` (texts), ``best`` (no pair of the first id has a higher count)."""
    handed = settled(found.select("block", "pairs").mapInArrow(_handed_in, "block long, pair int, n long"), "block-pairs")
    counts = settled(handed.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    first = F.expr(f"pair div {int(base)}")
    # one row for each id of the first vocabulary at most
    top = counts.groupBy(first.alias("first")).agg(F.max("count").alias("top"))
    marked = counts.withColumn("first", first).join(F.broadcast(top), "first").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    return handed.select("block", "pair"), marked


def _settle_block(left: pa.Table, right: pa.Table) -> pa.Table:
    order = np.argsort(pair := right.column("pair").to_numpy(), kind="stable")
    pair, count, best = pair[order], right.column("count").to_numpy()[order], right.column("best").to_numpy()[order]
    sums = ([], [])
    for batch in left.to_batches():
        pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
        at = np.searchsorted(pair, pairs.flatten().to_numpy())
        ends = np.cumsum([0, *pairs.value_lengths().to_pylist()])
        for out, each in zip(sums, (times * best[at], times * count[at])):
            total = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
            out.append(total[ends[1:]] - total[ends[:-1]])
    kept = left.drop_columns(["block", "pairs", "times"])
    for name, parts in zip(("n_best", "count_sum"), sums):
        kept = kept.append_column(name, pa.array(np.concatenate(parts) if parts else [], pa.int64()))
    return kept


def counted(found: DataFrame, base: int) -> DataFrame:
    """Rows of :func:`aligned` (their other columns stay) with ``n_best`` and ``count_sum`` for ``block``, ``pairs``, ``times``.

    ``base`` is the size of the second vocabulary. ``n_best`` has the links whose pair's count is the highest of their
    first id, ``count_sum`` the sum of all links' counts.
    """
    table = settled(found, "aligned")
    handed, counts = pair_counts(table, base)
    back = handed.join(counts, "pair").select("block", "pair", "count", "best")
    fields = [f for f in table.schema.fields if f.name not in ("block", "pairs", "times")]
    schema = T.StructType([*fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return table.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_settle_block, schema)


def piece_count(path: str) -> int:
    """Size of a piece vocabulary."""
    with open(path, "rb") as f:
        return len(Pieces(f.read()).pieces)
