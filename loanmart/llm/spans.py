"""Spans of a text as Column expressions: all matches of a pattern with their places, counted in code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<s:int,e:int,v:string,before:string,after:string>>"
#: Places that are added up at once, and characters behind a match that are handed over.
RUN, AFTER = 256, 8


def running(lengths: Column) -> Column:
    """Sums of an int array up to and with each element.

    In runs of ``RUN``: the sums inside a run, then those of the runs before it, so that the steps grow with the array
    and not with its square.
    """
    nothing = F.array().cast("array<int>")

    def sums(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), nothing.alias("out"))
        step = lambda state, x: F.struct((state["at"] + x).alias("at"), F.array_append(state["out"], state["at"] + x).alias("out"))
        return F.aggregate(values, start, step, lambda state: state["out"])

    runs = F.transform(F.sequence(F.lit(0), F.ceil(F.size(lengths) / RUN).cast("int") - 1), lambda i: sums(F.slice(lengths, i * RUN + 1, F.lit(RUN))))
    # one struct, so that the runs are made once
    held = F.transform(F.array(runs), lambda r: F.struct(r.alias("runs"), sums(F.transform(r, lambda x: F.element_at(x, -1))).alias("ends")))[0]
    whole = F.transform(F.array(held), lambda h: F.flatten(F.transform(h["runs"], lambda x, i: F.transform(x, lambda v: v + F.when(i == 0, 0).otherwise(F.get(h["ends"], i - 1))))))[0]
    return F.when(F.size(lengths) == 0, nothing).when(F.size(lengths) <= RUN, sums(lengths)).otherwise(whole)


def found(text: Column, pattern: str, hint: Column, context: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs of start ``s``, exclusive end ``e`` and value ``v``; with ``context``
    also up to so many characters ``before`` them, back to the beginning of the match before, and up to ``AFTER`` behind them.

    ``hint`` is a cheap condition that every text with a match meets. The places follow from the lengths of the matches
    and of the pieces between them, and what stands around from the pieces, so no text is searched from its start again.
    """
    both = F.struct(F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"))

    def spans(x: Column) -> Column:
        pieces, matches = x["pieces"], x["matches"]

        def one(m: Column, i: Column) -> Column:
            around = [F.lit("").alias("before"), F.lit("").alias("after")]
            if context:
                left = F.concat(F.coalesce(F.get(matches, i - 1), F.lit("")), F.get(pieces, i))
                right = F.concat(F.left(F.get(pieces, i + 1), F.lit(AFTER)), F.left(F.coalesce(F.get(matches, i + 1), F.lit("")), F.lit(AFTER)))
                around = [F.right(left, F.lit(context)).alias("before"), F.left(right, F.lit(AFTER)).alias("after")]
            e = F.get(x["ends"], i)
            return F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("v"), *around)

        return F.transform(matches, one)

    def with_ends(x: Column) -> Column:
        pieces, matches = x["pieces"], x["matches"]
        sizes = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.length(p) + F.length(m))
        return x.withField("ends", running(sizes))

    whole = F.transform(F.transform(F.array(both), with_ends), spans)[0]
    return F.when(F.coalesce(hint, F.lit(False)), whole).otherwise(F.array().cast(SPANS))


def blanked(text: Column, pattern: str) -> Column:
    """``text`` with a line feed for each character of the matches, so that all places stay."""
    both = F.struct(F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"))
    fill = lambda x: F.zip_with(x["pieces"], x["matches"], lambda p, m: F.concat(p, F.repeat(F.lit("\n"), F.coalesce(F.length(m), F.lit(0)))))
    return F.transform(F.array(both), lambda x: F.array_join(fill(x), ""))[0]


def last_before(spans: Column, at: Column) -> Column:
    """Of sorted spans that do not overlap the last that starts before ``at``, found by halving; null for none.

    It is the one that a span ending at ``at`` overlaps if it overlaps any: ends rise as starts do.
    """
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + F.lit(1))).cast("int"))

    def halve(state: Column, _: Column) -> Column:
        mid = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        below = F.get(spans, mid)["s"] < at
        open_ = state["lo"] < state["hi"]
        return F.struct(F.when(open_ & below, mid + 1).otherwise(state["lo"]).alias("lo"), F.when(open_ & ~below, mid).otherwise(state["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))
    return F.when(F.size(spans) > 0, F.get(spans, F.aggregate(steps, start, halve, lambda state: state["lo"]) - 1))


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def banded(value: Column, *tops: int) -> Column:
    """Number of the first band whose top is not below the value; one more band above the last."""
    out = F.lit(len(tops))
    for i, top in reversed(list(enumerate(tops))):
        out = F.when(value <= top, i).otherwise(out)
    return out


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def fold() -> Column:
    """True for the rows that thresholds are calibrated on and models not fitted on."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
