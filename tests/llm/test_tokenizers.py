"""Byte-level merges and the alignment of two vocabularies, against the public libraries and plain versions."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from loanmart.llm import byte_bpe, token_alignment
from loanmart.llm import queries as llm
from tests.llm import data

SF = "/root/testdata/sf0.01"
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_query_equals_the_library(spark, library):
    got = {r.doc_id: r for r in llm.QUERIES["op13_byte_bpe"](spark, SF).collect()}
    docs = llm.table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode_ordinary(r.text or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
        assert tuple(got[r.doc_id][1:]) == want


def test_bpe_of_odd_texts(ranks, library):
    rng, own = random.Random(4), byte_bpe.Encoder(ranks, PATTERN)
    parts = [" ", "  ", "a", "e", "é", "\n", "1", "😀", "th", "\x1c", "\x85", "'s", "ß", "ing", "\x00", "中", "ا", "<|endoftext|>", "Å", "҉"]
    for _ in range(800):
        text = "".join(rng.choices(parts, k=rng.randrange(60)))
        assert own.texts([text])[0].tolist() == library.encode_ordinary(text)


def test_bpe_counts_letters_as_the_library(ranks):
    """Merges with all pairs of a byte and a, 1 or ! show which characters share a piece with a letter, a digit or neither."""
    for mark in "a1!":
        pairs = {bytes([b]): b for b in range(256)}
        for b in range(256):
            pairs.setdefault(bytes([b]) + mark.encode(), len(pairs))
        own = byte_bpe.Encoder(pairs, PATTERN)
        theirs = tiktoken.Encoding("probe", pat_str=PATTERN, mergeable_ranks=pairs, special_tokens={})
        for low in range(0, 0x110000, 256):
            text = "\n".join(chr(c) + mark for c in range(low, low + 256) if not 0xD800 <= c < 0xE000)
            assert own.texts([text])[0].tolist() == theirs.encode_ordinary(text), hex(low)


@pytest.mark.parametrize("kind", ["one letter", "two letters", "random", "blanks"])
def test_bpe_of_very_long_pieces(ranks, library, kind):
    rng, n = random.Random(5), 150_000
    text = {"one letter": "a" * n, "two letters": "ab" * (n // 2), "random": "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)), "blanks": " " * n + "x"}[kind]
    assert byte_bpe.Encoder(ranks, PATTERN).texts([text])[0].tolist() == library.encode_ordinary(text)


def test_bpe_merges_lowest_rank_then_leftmost():
    """A rank lower than the one before may appear only after a merge; equal ranks go from left to right."""
    rng = random.Random(6)
    for _ in range(300):
        tokens = {bytes([b]) for b in b"abc"} | {bytes(rng.choices(b"abc", k=rng.randrange(2, 6))) for _ in range(12)}
        order = sorted(tokens, key=lambda _: rng.random())
        ranks = {t: i for i, t in enumerate(order)}
        words, want = [bytes(rng.choices(b"abc", k=rng.randrange(40))) for _ in range(4)], []
        for word in words:
            parts = [bytes([b]) for b in word]
            while True:
                best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
                if best is None:
                    break
                parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            want.append([ranks[p] for p in parts])
        assert byte_bpe.Encoder(ranks, PATTERN).merged(words) == want


def test_bpe_forgets_and_reads_parts(ranks, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5)
    monkeypatch.setattr(byte_bpe, "PART", 3)
    monkeypatch.setattr(byte_bpe, "CHUNK", 4)
    own, texts = byte_bpe.Encoder(ranks, PATTERN), ["one two three four five six seven", "", "seven one " * 30, "wordwordword" * 20]
    for _ in range(2):
        assert [x.tolist() for x in own.texts(texts)] == [library.encode_ordinary(t) for t in texts]


def test_bpe_defined_cases(spark, ranks, library):
    docs = data.documents(spark)
    out = byte_bpe.decoded(byte_bpe.encoded(docs, ranks, PATTERN), ranks)
    assert out.columns == [*docs.columns, "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert byte_bpe.encoded(docs.limit(0), ranks, PATTERN).collect() == []
    odd = spark.createDataFrame([(1, [None, 70, 99_999_999]), (2, None), (3, [])], "doc_id long, ids array<int>")
    word = {v: k for k, v in ranks.items()}[70]
    assert [bytes(r.decoded) for r in byte_bpe.decoded(odd, ranks).collect()] == [word, b"", b""]
    with pytest.raises(ValueError):
        byte_bpe.encoded(docs.withColumnRenamed("label", "IDS"), ranks, PATTERN)


LEFT, RIGHT = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabularies():
    with open(LEFT, encoding="utf-8") as a, open(RIGHT, "rb") as b:
        return token_alignment.ByteLevel(a.read()), token_alignment.Pieces(b.read())


def plain_groups(vocabularies, text):
    """Groups of a text by walking both sequences."""
    if not text:
        return []
    whole = (" " + text).encode()
    sides = []
    for v in vocabularies:
        ids = v.encode([text])[0]
        if b"".join(v.pieces[i] for i in ids) != whole:
            return []
        sides.append((ids, np.cumsum([len(v.pieces[i]) for i in ids]).tolist()))
    common, groups, at = set(sides[0][1]) & set(sides[1][1]), [], [0, 0]
    for cut in sorted(common):
        group = ([], [])
        for k, (ids, ends) in enumerate(sides):
            while at[k] < len(ends) and ends[at[k]] <= cut:
                group[k].append(ids[at[k]])
                at[k] += 1
        groups.append(group)
    return groups


def plain_rows(vocabularies, texts):
    """The query's columns without the id, for each text."""
    every = [plain_groups(vocabularies, t) for t in texts]
    linked = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in every]
    count = Counter(pair for links in linked for pair in links)
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for groups, links in zip(every, linked):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_query_equals_plain_version(spark, vocabularies):
    docs = llm.table(spark, SF, "documents").collect()
    want = dict(zip((r.doc_id for r in docs), plain_rows(vocabularies, [r.text for r in docs])))
    got = llm.QUERIES["op12_token_alignment"](spark, SF).collect()
    assert len(got) == len(docs) and {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got} == want


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_alignment_defined_cases(spark, vocabularies, block_bytes, monkeypatch):
    from pyspark.sql import functions as F

    more = ["a▁b", "<|endoftext|> <s> </s> <unk> <0x41>", "\u00a0 \u200b½ﬁ", " " * 5000 + "x" + " " * 700, "😀" * 3000, "中文字 ا ب", "a" * 20_000, "  two  blanks \n\t "]
    docs = data.documents(spark).union(data.documents(spark).where("doc_id = 1").select(F.lit(90).alias("doc_id"), F.explode(F.array(*map(F.lit, more))), *[
        c for c in data.documents(spark).columns[2:]]))
    found = token_alignment.aligned(docs, LEFT, RIGHT, block_bytes=block_bytes)
    slim = found.withColumn("groups_sha256", F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(""))
    out = token_alignment.counted(slim, token_alignment.piece_count(RIGHT))
    assert set(docs.columns) <= set(out.columns)
    rows = docs.collect()
    key = lambda r: (r[0] or -1, r[1] or "", *r[2:])
    want = sorted(((r.doc_id, r.text, *w) for r, w in zip(rows, plain_rows(vocabularies, [r.text for r in rows]))), key=key)
    assert sorted(((r.doc_id, r.text, *(r[c] for c in COLUMNS)) for r in out.collect()), key=key) == want
    none = token_alignment.counted(token_alignment.aligned(docs.limit(0), LEFT, RIGHT), token_alignment.piece_count(RIGHT))
    assert none.collect() == []
    with pytest.raises(ValueError):
        token_alignment.aligned(docs.withColumnRenamed("label", "Pairs"), LEFT, RIGHT)


def test_shared_cuts_anywhere():
    """Cuts at random, none, all, and only at the edges of long intervals."""
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 50, 2000):
        for share in (0.0, 0.02, 0.5, 1.0):
            own, other = (np.flatnonzero(rng.random(n * 3) < 0.4) * 2 + odd for odd in (0, 1))
            both = np.flatnonzero(rng.random(n * 3) < share * 0.3) * 2 + 10_000_000 * (n == 50)
            a, b = (np.unique(np.concatenate([x, both, [30_000_000]])) for x in (own, other))
            cuts = token_alignment.shared_cuts(a, b, *(np.array([x]) for x in (0, len(a), 0, len(b))))
            common = np.intersect1d(a, b)
            assert np.array_equal(a[cuts[0]], common) and np.array_equal(b[cuts[1]], common)


def test_links_of_large_groups():
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 9, 400), rng.integers(0, 7, 300)
    doc, pair, times = token_alignment.links(a, b, np.array([0, 10]), np.array([10, 390]), np.array([0, 4]), np.array([4, 296]), np.array([0, 1]), 7)
    want = Counter((0, int(x) * 7 + int(y)) for x in a[:10] for y in b[:4]) + Counter((1, int(x) * 7 + int(y)) for x in a[10:] for y in b[4:])
    assert dict(zip(zip(doc.tolist(), pair.tolist()), times.tolist())) == dict(want)
