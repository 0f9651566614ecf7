"""Conversations as a prefix trie: which beginnings they share, and what sharing them saves.

Method: a turn (role, text) has a fixed-width big-endian id, the first 16 bytes of a SHA-256; a conversation's key is its
ids end to end. Keys are dealt by range and sorted, so a frequent first turn is spread over many tasks. Each task reads
its keys as a stream and, for every run of at most ``unit_bytes`` of keys, fills an adaptive radix tree: nodes of
4, 16, 48 or 256 places that grow as children come, with the bytes that all keys below share kept as one path. A byte
depth that is a multiple of the id's width is a node of the trie, also inside such a path; others are not.

A unit's nodes are whole, but for those on the paths of its first and its last key, which other units may share. These
(as many as a path is long, twice for a unit) go through one stream in key order that keeps the current path only and
joins what neighbouring units have in common: the seam. Text never travels, only ids and byte counts; a conversation's
own ids and a tree of ``unit_bytes`` must fit into a task.

Members' ids are hashed as they stream by. Of a key that lies in two partitions, or has more ids than fit one piece, the
pieces of its list are hashed in order in a later step, a piece at a time.

Defined cases: turns go by ``turn`` (null first), equal ones by role, the first ``BEGINNING`` characters of the text and id;
repeated rows are turns of their own. A null role or text is empty. Rows without ``conv_id`` belong to no conversation. Other columns are not read. No rows give no nodes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.session import settled

#: Bytes of a turn's id, and characters of a text by which equal turns are ordered.
WIDTH, BEGINNING = 16, 32
#: Bytes of the keys in one tree, and characters of one piece of a list of members.
UNIT_BYTES, PIECE_CHARS = 8 << 20, 1 << 16
#: Rows handed to Spark at once.
ROWS = 20_000
NOBODY = hashlib.sha256(b"").hexdigest()

CLOSED, OPEN, PIECE = 0, 1, 2
_BUILT = ("kind int, unit long, side int, depth int, turn binary, bytes long, conv_id long, parent long, parent_side int, "
          "n_convs long, n_children long, n_leaves long, saved long, ends string, list binary, seq long, ids string")
_SEAM = "unit long, side int, depth int, conv_id long, parent long, n_convs long, n_children long, n_leaves long, saved long, ends string, node boolean"


# ---- conversations and keys

def turn_id(role, text):
    """16 bytes for a turn; the role's length keeps role and text apart."""
    return F.substring(F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)), 256)), 1, WIDTH)


def conversation_turns(rows: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``, structs of ``id`` and ``bytes`` (of the text) in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # equal turns go by role and text; the beginning stands for the text, which does not travel
    one = F.struct(F.col("turn"), role.alias("role"), F.left(text, F.lit(BEGINNING)).alias("begins"), F.hex(turn_id(role, text)).alias("id"),
                   F.octet_length(text).alias("bytes"))
    each = rows.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("t"))
    whole = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.select("conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["bytes"].alias("bytes"))).alias("turns"))


def rebuilt(turns: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Conversations that begin with another's turns: of c, the first h of conversation ``c - c % group``, then its own
    after its first h, where h is the CRC-32 of c as text modulo ``most``."""
    c = F.col("conv_id")
    base = c - c % group
    # as many turns as the largest h; one row for each group
    heads = turns.where(c % group == 0).select(c.alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    own = turns.withColumns({"base": base, "h": (F.crc32(c.cast("string").cast("binary")) % most).cast("int")})
    begin = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(heads, "base", "left").select("conv_id", F.concat(begin, rest).alias("turns"))


# ---- adaptive radix tree

class Node:
    """A node with sorted places for up to 16 children, an index of bytes up to 48, one place for each byte beyond.

    ``path`` are the bytes that all keys below share after the one that leads here; ``end`` is the number of the key
    that ends here, ``any`` that of some key below.
    """

    __slots__ = ("path", "end", "any", "layout", "bytes", "places")

    def __init__(self, path: bytes, end: int | None, some: int):
        self.path, self.end, self.any, self.layout = path, end, some, 4
        self.bytes, self.places = bytearray(), []

    def get(self, b: int) -> Node | None:
        if self.layout <= 16:
            i = bisect_left(self.bytes, b)
            return self.places[i] if i < len(self.bytes) and self.bytes[i] == b else None
        if self.layout == 48:
            return self.places[self.bytes[b] - 1] if self.bytes[b] else None
        return self.places[b]

    def put(self, b: int, child: Node) -> None:
        """A child at a byte, in place of one that is there."""
        if self.layout <= 16:
            i = bisect_left(self.bytes, b)
            if i < len(self.bytes) and self.bytes[i] == b:
                self.places[i] = child
                return
            if len(self.places) == self.layout:
                self._grow()
                self.put(b, child)
                return
            self.bytes.insert(i, b)
            self.places.insert(i, child)
        elif self.layout == 48:
            if self.bytes[b]:
                self.places[self.bytes[b] - 1] = child
                return
            if len(self.places) == 48:
                self._grow()
                self.put(b, child)
                return
            self.places.append(child)
            self.bytes[b] = len(self.places)
        else:
            self.places[b] = child

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            index = bytearray(256)
            for i, b in enumerate(self.bytes):
                index[b] = i + 1
            self.layout, self.bytes = 48, index
        else:
            self.layout, self.places = 256, [self.places[i - 1] if i else None for i in self.bytes]
            self.bytes = bytearray()

    def children(self) -> list[Node]:
        """In order of their bytes."""
        if self.layout <= 16:
            return self.places
        if self.layout == 48:
            return [self.places[i - 1] for i in self.bytes if i]
        return [c for c in self.places if c is not None]


def _common(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is common, a[:high] is not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def insert(root: Node | None, key: bytes, number: int) -> Node:
    """The tree with ``key``, which is not in it yet."""
    if root is None:
        return Node(key, number, number)
    node, above, at = root, None, 0
    while True:
        same = _common(node.path, key[at:at + len(node.path)])
        if same < len(node.path):  # the path parts here
            upper = Node(node.path[:same], None, number)
            upper.put(node.path[same], node)
            node.path = node.path[same + 1:]
            if above is None:
                root = upper
            else:
                above.put(key[at - 1], upper)
            node = upper
        at += same
        if at == len(key):
            node.end = number
            return root
        below = node.get(key[at])
        if below is None:
            node.put(key[at], Node(key[at + 1:], number, number))
            return root
        node, above, at = below, node, at + 1


# ---- one unit's nodes

@dataclass(slots=True)
class Key:
    """A distinct key with its members."""

    key: bytes
    sizes: list[int]
    low: int
    n: int
    ends: str | None
    #: id of a list of members that is hashed later
    list: bytes | None


@dataclass
class _Rows:
    rows: dict[str, list] = field(default_factory=lambda: {c.split()[0]: [] for c in _BUILT.split(", ")})

    def add(self, **values) -> None:
        for name, column in self.rows.items():
            column.append(values.get(name))

    def batch(self) -> pa.RecordBatch:
        kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
        names, types = zip(*(c.split() for c in _BUILT.split(", ")))
        return pa.RecordBatch.from_arrays([pa.array(self.rows[n], kinds[t]) for n, t in zip(names, types)], list(names))


def unit_rows(keys: list[Key], unit: int) -> Iterator[pa.RecordBatch]:
    """Rows of the trie of sorted distinct keys, some at a time."""
    root = None
    for number, k in enumerate(keys):
        root = insert(root, k.key, number)
    first, last = keys[0].key, keys[-1].key
    parent, depth, some, side, ends = [-1], [0], [root.any], [1], [None]  # the trie's root
    to_visit = [(root, 0, 0, True, True)]
    while to_visit:
        node, at, cur, on_first, on_last = to_visit.pop()
        stop = at + len(node.path)
        key = keys[node.any].key
        for d in range(depth[cur] + 1, stop // WIDTH + 1):
            turn = key[(d - 1) * WIDTH:d * WIDTH]
            on_first = on_first and first[(d - 1) * WIDTH:d * WIDTH] == turn
            on_last = on_last and last[(d - 1) * WIDTH:d * WIDTH] == turn
            parent.append(cur)
            depth.append(d)
            some.append(node.any)
            side.append(1 if on_first else 2 if on_last else 0)
            ends.append(None)
            cur = len(parent) - 1
        if node.end is not None:
            ends[cur] = node.end
        to_visit += [(c, stop + 1, cur, on_first, on_last) for c in reversed(node.children())]
    count = len(parent)
    n, low, children, leaves, saved = [0] * count, [None] * count, [0] * count, [0] * count, [0] * count
    for i in range(count - 1, -1, -1):  # parents stand before their children
        if ends[i] is not None:
            own = keys[ends[i]]
            n[i] += own.n
            low[i] = own.low if low[i] is None else min(low[i], own.low)
        if i and not side[i]:
            if not children[i]:
                leaves[i] = 1
            saved[i] += (n[i] - 1) * keys[some[i]].sizes[depth[i] - 1]
        if i:
            p = parent[i]
            n[p] += n[i]
            low[p] = low[i] if low[p] is None else min(low[p], low[i])
            if not side[i]:
                children[p] += 1
                leaves[p] += leaves[i]
                saved[p] += saved[i]
    out = _Rows()
    for i in range(count):
        own, p, d = keys[ends[i]] if ends[i] is not None else None, parent[i], depth[i]
        closed = not side[i]
        out.add(kind=CLOSED if closed else OPEN, unit=unit, side=side[i] if not closed else None, depth=d,
                turn=None if closed or not d else keys[some[i]].key[(d - 1) * WIDTH:d * WIDTH], bytes=None if closed else keys[some[i]].sizes[d - 1] if d else 0,
                conv_id=low[i], parent=low[p] if closed and not side[p] else None, parent_side=side[p] if closed else None,
                n_convs=n[i], n_children=children[i], n_leaves=leaves[i], saved=saved[i],
                ends=own.ends if own else NOBODY if closed else None, list=own.list if own else None)
        if len(out.rows["kind"]) >= ROWS:
            yield out.batch()
            out = _Rows()
    yield out.batch()


def _units(unit_bytes: int, piece_chars: int):
    """Trees of a partition's sorted rows ``key``, ``sizes``, ``conv_id``."""

    def runs(batches) -> Iterator[tuple]:
        """Distinct keys, and before each the pieces of its list that are hashed later."""
        key, sizes, low, n, ids, chars, seq, first = None, None, 0, 0, [], 0, 0, True

        def piece(whole: bool):
            text = ",".join(ids) if whole else ",".join(ids) + ","
            return hashlib.sha256(key).digest()[:WIDTH], seq, text

        def ended(last: bool):
            if first or last or seq:  # neighbours may hold the same key, or a part has gone ahead
                yield piece(True)
                yield Key(key, sizes, low, n, None, hashlib.sha256(key).digest()[:WIDTH])
            else:
                yield Key(key, sizes, low, n, hashlib.sha256(",".join(ids).encode()).hexdigest(), None)

        for batch in batches:
            for k, s, c in zip(*(batch.column(x).to_pylist() for x in ("key", "sizes", "conv_id"))):
                if k != key:
                    if key is not None:
                        yield from ended(False)
                        first = False
                    key, sizes, low, n, ids, chars, seq = k, s, c, 0, [], 0, 0
                elif chars > piece_chars:
                    yield piece(False)
                    ids, chars, seq = [], 0, seq + 1
                n += 1
                ids.append(str(c))
                chars += len(ids[-1]) + 1
        if key is not None:
            yield from ended(True)

    def work(batches):
        unit, keys, held, pieces = TaskContext.get().partitionId() << 32, [], 0, _Rows()
        for x in runs(batches):
            if not isinstance(x, Key):
                pieces.add(kind=PIECE, unit=unit, list=x[0], seq=x[1], ids=x[2])
                if len(pieces.rows["kind"]) >= 64:
                    yield pieces.batch()
                    pieces = _Rows()
                continue
            if held and held + len(x.key) > unit_bytes:
                yield from unit_rows(keys, unit)
                unit, keys, held = unit + 1, [], 0
            keys.append(x)
            held += len(x.key) + WIDTH
        if pieces.rows["kind"]:
            yield pieces.batch()
        if keys:
            yield from unit_rows(keys, unit)

    return work


# ---- what units share

def _hashed(batches):
    """One digest for each list, of its pieces in order."""
    key, state, low, open_ = None, None, None, False
    done: dict[str, list] = {"list": [], "digest": []}

    def out():
        batch = pa.RecordBatch.from_arrays([pa.array(done["list"], pa.binary()), pa.array(done["digest"], pa.string())], ["list", "digest"])
        done["list"], done["digest"] = [], []
        return batch

    for batch in batches:
        for k, text in zip(batch.column("list").to_pylist(), batch.column("ids").to_pylist()):
            if k != key:
                if key is not None:
                    done["list"].append(key)
                    done["digest"].append(state.hexdigest())
                key, state, open_ = k, hashlib.sha256(), False
            if open_ and text:
                state.update(b",")  # the part before ended in another partition
            state.update(text.encode())
            open_ = bool(text) and not text.endswith(",")
        if len(done["list"]) > 1000:
            yield out()
    if key is not None:
        done["list"].append(key)
        done["digest"].append(state.hexdigest())
        yield out()


@dataclass(slots=True)
class _Open:
    """A node of the current path."""

    turn: bytes | None
    depth: int
    bytes: int
    low: int | None = None
    n: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str | None = None
    #: (unit, side) of the paths it is on, and its own children's results
    on: list = field(default_factory=list)
    below: list = field(default_factory=list)


def _seam(batches):
    """Join the first and last paths of all units, which come in key order."""
    names = [c.split()[0] for c in _SEAM.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in _SEAM.split(", ")]
    path: list[_Open] = []
    rows: list[tuple] = []

    def left():
        """The path's last node gets no more."""
        node = path.pop()
        if not node.children:
            node.leaves = 1
        node.saved += (node.n - 1) * node.bytes
        own = (node.depth, node.low, node.n, node.children, node.leaves, node.saved, node.ends or NOBODY)
        rows.extend((unit, side, node.depth, node.low, None, None, None, None, None, None, False) for unit, side in node.on)
        rows.extend((None, None, d, low, node.low, n, c, lv, sv, e, True) for d, low, n, c, lv, sv, e in node.below)
        if path:
            up = path[-1]
            up.children, up.leaves, up.saved = up.children + 1, up.leaves + node.leaves, up.saved + node.saved
            up.below.append(own)
        else:
            d, low, n, c, lv, sv, e = own
            rows.append((None, None, d, low, None, n, c, lv, sv, e, True))

    def out():
        columns = list(zip(*rows)) or [()] * len(names)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        for r in batch.to_pylist():
            d = r["depth"]
            if d < len(path) and path[d].turn != r["turn"]:
                while len(path) > d:
                    left()
            if d == len(path):
                path.append(_Open(r["turn"], d, r["bytes"]))
            node = path[d]
            node.n += r["n_convs"]
            node.low = r["conv_id"] if node.low is None else min(node.low, r["conv_id"])
            node.children, node.leaves, node.saved = node.children + r["n_children"], node.leaves + r["n_leaves"], node.saved + r["saved"]
            node.ends = r["ends"] or node.ends
            node.on.append((r["unit"], r["side"]))
        if len(rows) > 10_000:
            yield out()
    while path:
        left()
    yield out()


def prefix_trie(conversations: DataFrame, unit_bytes: int = UNIT_BYTES, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """A row for each node of the trie of ``conv_id``, ``turns`` (structs of hex ``id`` and ``bytes``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes that members need not repeat, summed over the subtree), ``ends_sha256`` (of the ids of the
    members that end here).
    """
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    keyed = conversations.select(key.alias("key"), F.transform("turns", lambda t: t["bytes"]).alias("sizes"), "conv_id")
    ranged = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    built = settled(ranged.mapInArrow(_units(unit_bytes, piece_chars), _BUILT), "trie")
    pieces = built.where(F.col("kind") == PIECE).select("list", "unit", "seq", "ids")
    digests = pieces.repartition("list").sortWithinPartitions("list", "unit", "seq").select("list", "ids").mapInArrow(_hashed, "list binary, digest string")
    digests = settled(digests, "long-lists")

    def with_ends(nodes: DataFrame) -> DataFrame:
        some = nodes.where(F.col("list").isNotNull()).join(digests, "list").withColumn("ends", F.col("digest")).select(*nodes.columns)
        return nodes.where(F.col("list").isNull()).unionByName(some)

    shared = with_ends(built.where(F.col("kind") == OPEN)).select("unit", "side", "depth", "turn", "bytes", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends")
    seam = settled(shared.repartition(1).sortWithinPartitions("unit", "side", "depth").mapInArrow(_seam, _SEAM), "seam")
    values = ["conv_id", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    closed = with_ends(built.where(F.col("kind") == CLOSED))
    inner = closed.where("parent_side = 0").select(*values)
    places = seam.where("not node").select(F.col("unit"), F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("at"))
    outer = closed.where("parent_side > 0").join(places, ["unit", "parent_side", "depth"]).withColumn("parent", F.col("at")).select(*values)
    nodes = inner.unionByName(outer).unionByName(seam.where("node").select(*values))
    return nodes.select("conv_id", F.col("depth").cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
