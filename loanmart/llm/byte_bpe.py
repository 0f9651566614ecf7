"""Byte-level BPE: token ids of whole texts by a table of merge ranks, and their bytes again.

Method: a text is cut by a pattern; the pieces that are no token themselves start as a linked list of their bytes, all
pieces of a run of texts in one list with walls between them. A queue has one bucket of list positions for each merge
rank and a bitmap of two levels of the buckets in use: find-first-set in the top level and then in the word it names
gives the lowest rank. Its positions are merged from left to right; each merge unlinks one node and files at most two new
pairs, and entries of pairs that a merge has changed since are stale and skipped. Should a merge make a pair of a lower
rank, the rest of the bucket goes back and waits for that. A piece of n bytes takes O(n log n) steps, whatever its
length. Pieces that come again soon are merged once.

Spark deals the rows; nothing is shuffled. The rank table is read on the driver and broadcast: its size is that of the
vocabulary file, not of the data.

Defined cases: a null or empty text has no ids, no ids decode to no bytes. Text that looks like a special token is
ordinary text. Null ids and ids outside the table decode to nothing. All other columns stay; the new column must not be
there yet (``ValueError``). Repeated rows get equal results, no rows give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterable
from itertools import accumulate, batched, chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loanmart.llm.text import CHUNK, slices

#: Pieces of a long text that are merged at once.
PART = 200_000
#: Pieces up to so many characters, and so many of them in each of two generations, are remembered in a task.
REMEMBERED_CHARS, REMEMBERED = 64, 250_000

# Letters and digits that Unicode has had since version 17. The merge tables' own library counts by
# version 16, so for it they are neither; ``regex`` knows them.
NEWER_LETTERS = (
    "՘ ֋-֌ ࢏ ౜ ೜ ₏ ₝-₟ ꟎-꟏ ꟒ ꟔ ꟝ ꟢ ꟱ ꭬-꭭ "
    "\U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 \U00010ed9-\U00010eee \U00011b0a \U00011db0-\U00011ddb \U00011df1 "
    "\U00016ea0-\U00016eb8 \U00016ebb-\U00016ed3 \U00016ff2-\U00016ff3 \U000187f8-\U000187ff \U00018cd6-\U00018cda \U00018d09-\U00018d20 "
    "\U00018d80-\U00018df2 \U00018e00-\U00019191 \U000191a0-\U000191d2 \U0001b123-\U0001b128 \U0001b168 \U0001d6a6 \U0001df1f-\U0001df24 "
    "\U0001df2b-\U0001df81 \U0001df90-\U0001df96 \U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de \U0001e6e0-\U0001e6e2 \U0001e6e4-\U0001e6e5 "
    "\U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff \U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead "
    "\U000323b0-\U00033479 \U0003d000-\U0003fc3f"
).replace(" ", "")
NEWER_DIGITS = "\U00011de0-\U00011de9 \U0001246f \U00012475-\U0001247f \U00012550-\U00012686 \U00016ff4-\U00016ff6".replace(" ", "")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class Encoder:
    """Ids of texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        # two levels serve any number of ranks, as a word has about the root of that many bits
        self.shift = (max(ranks.values(), default=0).bit_length() + 1) // 2
        self.plain = regex.compile(pattern)
        letters, digits = rf"[\p{{L}}--[{NEWER_LETTERS}]]", rf"[\p{{N}}--[{NEWER_DIGITS}]]"
        self.strict = regex.compile(pattern.replace(r"\p{L}", letters).replace(r"\p{N}", digits), regex.V1)
        self.newer = re.compile(f"[{NEWER_LETTERS}{NEWER_DIGITS}]")
        self.pairs = {(a, b): ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)}
        # pieces met lately, four bytes an id; what is not met again while a generation fills up goes with the next one
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece after all merges: of a piece, the lowest rank first, and of one rank the leftmost first."""
        # one list for all pieces; a wall stands before, between and behind them
        data = b"\0" + b"\0".join(pieces) + b"\0"
        n, rank_of, shift, mask = len(data), self.ranks.get, self.shift, (1 << self.shift) - 1
        wall = bytearray(n + 1)
        for at in accumulate([0, *(len(p) + 1 for p in pieces)]):
            wall[at] = 1
        after, before = list(range(1, n + 1)), list(range(-1, n))
        # the rank of the pair that begins at a node, -1 for none
        pair = [-1 if at_wall or next_wall else self.pairs[x] for at_wall, next_wall, x in zip(wall, wall[1:], zip(data, data[1:]))]
        pair.append(-1)
        # positions by rank; a bit in ``words`` for each rank that has some, a bit in ``used`` for each word that is not zero
        buckets: dict[int, list[int]] = {}
        words, used = [0] * (1 << shift), 0
        for i, rank in enumerate(pair):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    words[rank >> shift] |= 1 << (rank & mask)
                    used |= 1 << (rank >> shift)
        while used:
            w = (used & -used).bit_length() - 1
            word = words[w]
            rank = w << shift | (word & -word).bit_length() - 1
            words[w] = word & (word - 1)
            if not words[w]:
                used &= used - 1
            bucket = buckets.pop(rank)
            bucket.sort()
            lower = rank
            for at, i in enumerate(bucket):
                if pair[i] != rank:
                    continue  # stale
                gone = after[i]
                after[i] = end = after[gone]
                before[end] = i
                pair[gone] = -1
                if wall[end]:
                    pair[i] = -1
                else:
                    pair[i] = new = rank_of(data[i:after[end]], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            words[new >> shift] |= 1 << (new & mask)
                            used |= 1 << (new >> shift)
                        if new < lower:
                            lower = new
                left = before[i]
                if not wall[left]:
                    pair[left] = new = rank_of(data[left:end], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(left)
                        else:
                            buckets[new] = [left]
                            words[new >> shift] |= 1 << (new & mask)
                            used |= 1 << (new >> shift)
                        if new < lower:
                            lower = new
                if lower < rank and at + 1 < len(bucket):
                    # a merge made a pair of a lower rank, which goes before the rest of this bucket
                    buckets[rank] = bucket[at + 1:] + buckets.get(rank, [])
                    words[rank >> shift] |= 1 << (rank & mask)
                    used |= 1 << (rank >> shift)
                    break
        out, ids, at, ranks = [], [], 1, self.ranks
        while at < n:
            if wall[at]:
                out.append(ids)
                ids, at = [], at + 1
            else:
                ids.append(ranks[data[at:after[at]]])
                at = after[at]
        return out

    def read(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of pieces; one that is a token itself is not merged."""
        data = [p.encode("utf-8", "replace") for p in pieces]
        whole = [self.ranks.get(d) for d in data]
        made = iter(self.merged([d for d, w in zip(data, whole) if w is None]))
        return [array("i", [w] if w is not None else next(made)).tobytes() for w in whole]

    def ids(self, cut: list[list[str]]) -> list[np.ndarray]:
        """Ids of texts given as their pieces."""
        known, older = self.known, self.older
        words = set(chain.from_iterable(cut))
        missing = [w for w in words if w not in known]
        for w in missing:
            if w in older:
                known[w] = older[w]
        missing = [w for w in missing if w not in known]
        known.update(zip(missing, self.read(missing)))
        out = [np.frombuffer(b"".join(map(known.__getitem__, pieces)), dtype=np.int32) for pieces in cut]
        for w in missing:
            if len(w) > REMEMBERED_CHARS:
                del known[w]
        if len(known) > REMEMBERED:
            self.known, self.older = {}, known
        return out

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        patterns = [self.strict if not t.isascii() and self.newer.search(t) else self.plain for t in texts]
        if sum(map(len, texts)) <= 2 * CHUNK:
            return self.ids([p.findall(t) for p, t in zip(patterns, texts)])
        out = []
        for pattern, text in zip(patterns, texts):  # a long text's pieces come a part at a time
            parts = batched(map(itemgetter(0), pattern.finditer(text)), PART)
            out.append(np.concatenate([np.zeros(0, dtype=np.int32), *(self.ids([list(p)])[0] for p in parts)]))
        return out


#: By table and pattern: a worker's next task finds the pieces that its last one has met.
_READY: dict[tuple[str, str], Encoder] = {}


def _encoder(mark: str, ranks: dict[bytes, int], pattern: str) -> Encoder:
    if (mark, pattern) not in _READY:
        _READY.clear()
        _READY[mark, pattern] = Encoder(ranks, pattern)
    return _READY[mark, pattern]


def listed(parts: Iterable[np.ndarray]) -> pa.Array:
    """A column of int lists."""
    parts = list(parts)
    ends = np.cumsum([0, *map(len, parts)])
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(values.astype(np.int32), pa.int32())).cast(pa.list_(pa.int32()))


def _with(docs: DataFrame, made: str, kind: T.DataType, work: Callable) -> DataFrame:
    if made.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {made} already")
    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(made, kind)]))


def encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` as an int array."""
    table = docs.sparkSession.sparkContext.broadcast(ranks)
    mark = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()

    def work(batches):
        encoder = _encoder(mark, table.value, pattern)
        for batch in slices(batches, text):
            yield batch.append_column(ids, listed(encoder.texts([t or "" for t in batch.column(text).to_pylist()])))

    return _with(docs, ids, T.ArrayType(T.IntegerType()), work)


def decoded(docs: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of the tokens in the int array ``ids``."""
    table = docs.sparkSession.sparkContext.broadcast(ranks)

    def work(batches):
        tokens = [b""] * (max(table.value.values(), default=-1) + 2)  # the last is for all that are unknown
        for token, rank in table.value.items():
            tokens[rank] = token
        data, size = np.frombuffer(b"".join(tokens), dtype=np.uint8), np.array([len(x) for x in tokens])
        start = np.cumsum(size) - size
        for batch in batches:
            rows = batch.column(ids)
            row_ends = np.cumsum(np.concatenate([[0], pc.fill_null(pc.list_value_length(rows), 0).to_numpy()]))
            at = 0
            while at < batch.num_rows:
                # rows of about CHUNK tokens, one at least
                to = max(at + 1, int(np.searchsorted(row_ends, row_ends[at] + CHUNK, side="right")) - 1)
                flat = pc.fill_null(rows.slice(at, to - at).flatten(), -1).to_numpy(zero_copy_only=False)
                flat = np.where((flat < 0) | (flat >= len(tokens)), len(tokens) - 1, flat)
                n = size[flat]
                stop = np.concatenate([[0], np.cumsum(n)])
                text = data[np.repeat(start[flat] - stop[:-1], n) + np.arange(stop[-1])]
                ends = stop[row_ends[at:to + 1] - row_ends[at]]
                made = pa.Array.from_buffers(pa.large_binary(), to - at, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text.tobytes())])
                yield batch.slice(at, to - at).append_column(out, made.cast(pa.binary()))
                at = to

    return _with(docs, out, T.BinaryType(), work)

