"""Rows for the defined cases, and plain versions of the operators to compare with."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row int, t1 string, fp string, at array<int>, node long, label string, words string, `__keep` boolean, `__t1` string, `__id` long, `__n_lines` int, `__b1` string, `__n` int, `__w` double"
ABC = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LINE = "A line that is long enough to be counted, " * 2
BLANK = " \t\n\x0b\x0c\r"


def documents(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, and columns with clashing names."""
    texts = [
        (1, f"First.\n{LINE}\nend"), (2, f"{LINE}\n{LINE}\n Second"), (3, f"  {LINE.upper()}\t\nThird"), (4, f"x\n{LINE}"), (5, f"{LINE}\ny"),
        (6, LINE), (7, LINE), (8, ""), (9, None), (None, None), (None, f"no id\n{LINE}"), (10, " \t\n \n"), (11, "word " * 30_000), (11, "word " * 30_000),
        (12, "twice"), (12, "twice, but another text"), (13, "ÄÖ é 😀 mail a.b@c.de +1 (456) 555-2186 10.0.0.1 4111 1111 1111 1111 token=\"0a1b2c3d4e5f60718293\""),
        (14, "Licensed under CC BY-NC 4.0. cc by cc by. General Public License; all rights reserved, all rights reserved"), (15, "a b"), (16, "\x00 \x01 b"),
    ]
    rows = [(i, t, "en" if i and i % 2 else None, "src" if i and i % 3 else None, None if t is None else len(t), 1, "x", "y", [1], 5, "z", None, True, "t", 7, 1, "b", 2, None) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def linked(ids, pairs):
    """Smallest id reachable, by id."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c)
        total += x if i % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    out = []
    for i, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), i, kind, m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ABC))


def places(words, phrases):
    found = [(i, label) for label, p in phrases for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    return len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None), ",".join(sorted({x for _, x in found}))


def kept_lines(rows, min_chars=40, min_docs=5):
    """(id, lines, dropped, text) of each (id, text); a null id counts as one id below all others."""
    key = lambda line: line.strip(BLANK).translate(ABC)
    place = lambda i: -1 << 63 if i is None else i
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(place(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and max(holders[key(x)]) != place(i))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def fingerprint(text, n=3):
    import xxhash

    w = (text or "").encode("utf-8").lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def align(item, words, cost=0.25):
    """Best local alignment score, cell by cell."""
    above, best = [0.0] * (len(words) + 1), 0.0
    for a in item:
        row = [0.0]
        for j, b in enumerate(words):
            row.append(max(0.0, above[j] + (1 if a == b else -cost), above[j + 1] - cost, row[j] - cost))
        best, above = max(best, *row), row
    return best
