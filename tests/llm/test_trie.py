"""The conversation trie against a plain one, its tree by itself, and defined cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from loanmart.llm import conversation_trie as trie
from loanmart.llm import queries as llm
from loanmart.session import staging

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
ROWS = "conv_id long, turn long, role string, text string, key int, unit long, id string, bytes string"


def plain_rebuilt(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, role, text[:32], digest[:32]), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rest = abs(c) % 5 * (1 if c >= 0 else -1)
        out[c] = tuple(own.get(c - rest, [])[:h] + own[c][h:])
    return out


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children.get(p, ())), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if convs[c] == p))).encode()).hexdigest()) for p, m in members.items())


def rows_of(nodes):
    return sorted(tuple(-1 if c == "parent_conv_id" and r[c] is None else r[c] for c in COLUMNS) for r in nodes.collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], ROWS)


def conversations(seed=1, convs=400):
    """Common beginnings of all lengths, copies, a frequent first turn, texts of all sizes, null and equal turns."""
    rng = random.Random(seed)
    told = [("user", "hi"), ("assistant", "hello"), ("user", ""), (None, None), ("user", "ä" * 50), ("", "user"), ("us", "er"), ("system", "x" * 3000)]
    rows = []
    for c in range(convs):
        begin = [told[0]] if rng.random() < 0.4 else []
        for t, (role, text) in enumerate(begin + rng.choices(told, k=rng.choice((1, 2, 3, 5, 9, 14)))):
            rows.append((c * rng.choice((1, 1, 3)) if c % 50 else -c - 3, t, role, text))
    copies = [(told[0][0], told[0][1]), told[1], told[4]]
    rows += [(10_000 + c, t, *x) for c in range(300) for t, x in enumerate(copies)]
    rows += [(5_001, None, "user", "first"), (5_001, 0, "user", "second"), (5_001, 0, "user", "second"), (None, 1, "user", "lost"), (5_003, None, None, None)]
    rows += [(20_000 + c, t, "user", f"{t}") for c in (0, 1, 5) for t in range(300 + c)]
    return rows


@pytest.mark.parametrize("unit_bytes, piece_chars, parts", [(1 << 20, 1 << 16, 4), (1, 1, 7), (200, 30, 16), (2_000, 10, 1)])
def test_trie_equals_plain_one(spark, unit_bytes, piece_chars, parts):
    rows = conversations()
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with staging(spark):
            turns = trie.conversation_turns(table(spark, rows))
            assert rows_of(trie.prefix_trie(trie.rebuilt(turns), unit_bytes, piece_chars)) == plain_trie(plain_rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_trie_of_all_given_conversations(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in llm.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    with staging(spark):
        assert rows_of(llm.QUERIES["op11_conversation_trie"](spark, sf)) == plain_trie(plain_rebuilt(rows))


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")], [(3, None, None, None)], [(7, 0, "user", "a")], [(1, 0, "user", "a"), (2, 0, "user", "a")]])
def test_trie_of_few_rows(spark, rows):
    with staging(spark):
        found = rows_of(trie.prefix_trie(trie.rebuilt(trie.conversation_turns(table(spark, rows)))))
    convs = plain_rebuilt(rows)
    assert found == (plain_trie(convs) if convs else [])


def test_tree_grows_through_its_layouts():
    rng, root, layouts = random.Random(2), None, set()
    keys = {bytes(rng.choices(range(256), k=rng.randrange(1, 4))) + b"tail" * rng.randrange(3) for _ in range(3000)} | {b""}
    for number, key in enumerate(order := sorted(keys, key=lambda _: rng.random())):
        root = trie.insert(root, key, number)
    found, todo = [], [(root, b"")]
    while todo:
        node, before = todo.pop()
        layouts.add(node.layout)
        here = before + node.path
        assert order[node.any].startswith(here)
        if node.end is not None:
            assert order[node.end] == here
            found.append(here)
        for b in range(256):
            if (below := node.get(b)) is not None:
                todo.append((below, here + bytes([b])))
        assert [c for b in range(256) if (c := node.get(b)) is not None] == node.children()
    assert sorted(found) == sorted(keys) and layouts == {4, 16, 48, 256}
