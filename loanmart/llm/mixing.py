"""Sampling documents so that their tokens meet source, language and topic shares: iterative proportional fitting.

Method: documents are counted by cell (source, language, topic), and the cells' token weights are raked to each of the
three marginals in turn until all agree; then a document of a cell is drawn with probability
``min(1, rate * weight of the cell / its tokens)``, where ``rate`` makes the expected tokens a given share of all.
``weight`` of a drawn document is the rest of the raking weight, so the weighted tokens meet the targets where a
probability was cut to 1. Counting adds up before the shuffle, so a hot source costs one row for each task; raking works
on cells. Draws are hashes of id and text: a repeated task draws alike.

Topics are clusters of documents by hashed character 4-grams (spherical k-means over all rows, started from the
documents with the smallest hashes, a fixed number of rounds). Tokens are words between white space.

Defined cases: a null source or language is a value of its own; null and empty texts have no tokens, belong to topic 0
and are drawn with probability 1 and weight 1 (they cost nothing). Targets default to each marginal's own shares raised
to ``power`` and scaled to 1; given targets are scaled over the values that occur, values without a target get none of
the tokens. Rows that repeat an id and text are drawn alike. No documents give no rows. Other columns are kept by
``sampled`` and not read by ``mixture``.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.llm.columns import free
from loanmart.llm.text import mixed, raw, slices, sums
from loanmart.session import settled

AXES = ("source", "lang", "topic")
SIZE = 64
INNER_ROUNDS = 500
_SKETCH = "doc_id long, source string, lang string, t1 long, t2 long, n_tokens long, sketch binary"


def _sketches(batches):
    """Tokens of each text and its 4-gram profile: counts in ``SIZE`` buckets, damped, of length 1."""
    blank = np.zeros(256, dtype=bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    for batch in slices(batches):
        data, offsets = raw(batch.column("text"))
        n = batch.num_rows
        begin = ~blank[data]
        begin[1:] &= blank[data[:-1]]
        edge = offsets[:-1][offsets[:-1] < len(data)]
        begin[edge] = ~blank[data[edge]]
        tokens = sums(begin, offsets).astype(np.int64)
        code = data.astype(np.uint64)
        profile = np.zeros((n, SIZE), dtype=np.float32)
        if len(code) >= 4:
            gram = code[:-3] | code[1:-2] << np.uint64(8) | code[2:-1] << np.uint64(16) | code[3:] << np.uint64(24)
            bucket = (mixed(gram) % np.uint64(SIZE)).astype(np.int64)
            doc = np.repeat(np.arange(n), np.diff(offsets))
            same = doc[:-3] == doc[3:]
            profile += np.bincount(doc[:-3][same] * SIZE + bucket[same], minlength=n * SIZE).reshape(n, SIZE)
        profile = np.sqrt(profile)
        profile /= np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-9)
        packed = pa.array([p.tobytes() for p in profile.astype("<f4")], pa.binary())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "source", "lang", "t1", "t2")), pa.array(tokens), packed],
                                         ["doc_id", "source", "lang", "t1", "t2", "n_tokens", "sketch"])


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f4").reshape(-1, SIZE)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    topic = (x @ centres.T).argmax(axis=1)
    topic[~x.any(axis=1)] = 0
    return topic


def _centres(sketches: DataFrame, topics: int, rounds: int) -> np.ndarray:
    """Spherical k-means; each round adds the rows up in the tasks and sends one sum for each topic and task."""
    first = sketches.where("n_tokens > 0").select("t1", "sketch").distinct().orderBy("t1", "sketch").limit(topics).collect()
    centres = np.stack([np.frombuffer(r.sketch, dtype="<f4") for r in first]) if first else np.zeros((1, SIZE), dtype=np.float32)
    for _ in range(rounds if first else 0):
        now = centres

        def add(batches, now=now):
            total = np.zeros((len(now), SIZE))
            for batch in batches:
                x = _rows(batch.column("sketch"))
                np.add.at(total, _nearest(x, now), x)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(now)), pa.int32()), pa.array(total.tolist())], ["topic", "total"])

        part = sketches.mapInArrow(add, "topic int, total array<double>").select("topic", F.posexplode("total").alias("i", "v"))
        total = np.zeros(centres.shape)
        for topic, i, v in part.groupBy("topic", "i").agg(F.sum("v")).collect():  # topics x SIZE numbers
            total[topic, i] = v
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(size > 0, total / np.maximum(size, 1e-12), centres).astype(np.float32)
    return centres


def profiled(docs: DataFrame, topics: int = 8, rounds: int = 5) -> DataFrame:
    """``doc_id``, ``source``, ``lang``, ``t1``, ``t2`` (the text's hashes), ``n_tokens``, ``topic`` of each row."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), "text",
                      F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    sketches = settled(own.mapInArrow(_sketches, _SKETCH), "sketches")
    centres = _centres(sketches, topics, rounds)

    def assign(batches):
        for batch in batches:
            topic = pa.array(_nearest(_rows(batch.column("sketch")), centres), pa.int32()) if batch.num_rows else pa.array([], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], topic], [*batch.schema.names[:-1], "topic"])

    return settled(sketches.mapInArrow(assign, _SKETCH.replace("sketch binary", "topic int")), "profiles")


def _goal(values: dict, targets: Mapping | None, power: float) -> dict:
    """Share of each value that has tokens."""
    raw = {k: (float(targets.get(k, 0.0)) if targets is not None else float(t) ** power) for k, t in values.items() if t > 0}
    total = sum(raw.values())
    return {k: v / total if total else 0.0 for k, v in raw.items()}


def rake(cells: DataFrame, targets: Mapping[str, Mapping] | None = None, power: float = 0.5, tolerance: float = 1e-4, most_rounds: int = 15) -> DataFrame:
    """``cells`` (columns ``source``, ``lang``, ``topic``, ``tokens``) with ``w``, whose sums over each axis meet the targets.

    ``targets`` maps an axis to shares by value. A source's row holds its cells, and a round scales each source to its
    goal where the row lies, adds up languages by topics (two code sets of bounded size) and scales those in turn. Ends
    when no marginal is off by more than ``tolerance`` of all, or after ``most_rounds`` (targets that contradict each
    other have no exact solution).
    """
    spark = cells.sparkSession
    given = targets or {}
    some = cells.where("tokens > 0")
    sums_of = lambda axis: {r[0]: r[1] for r in some.groupBy(axis).agg(F.sum("tokens")).collect()}
    goals = [_goal(sums_of(a), given.get(a), power) for a in ("lang", "topic")]
    place = [{k: i for i, k in enumerate(g)} for g in goals]
    goal_l, goal_t = (np.array(list(g.values())) for g in goals)
    by = some.groupBy("source").agg(F.sum("tokens").alias("all"), F.collect_list(F.struct("lang", "topic", "tokens")).alias("cells"))
    if "source" in given:
        shares = spark.createDataFrame([(k, float(v)) for k, v in given["source"].items()], "__k string, raw double")
        by = by.join(shares, F.col("source").eqNullSafe(F.col("__k")), "left").withColumn("raw", F.coalesce("raw", F.lit(0.0))).drop("__k")
    else:
        by = by.withColumn("raw", F.pow("all", F.lit(power)))
    rows = settled(by, "source-cells")
    whole = float(rows.agg(F.sum("raw")).first()[0] or 1.0)
    # logarithms, as factors run away in opposite directions where targets contradict each other
    factor_l, factor_t = np.zeros(len(goal_l)), np.zeros(len(goal_t))

    def scaled(batch, factor_l, factor_t):
        lists = batch.column("cells")
        inner = lists.flatten()
        row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        at_l = np.array([place[0][k] for k in inner.field("lang").to_pylist()], dtype=np.int64)
        at_t = np.array([place[1][k] for k in inner.field("topic").to_pylist()], dtype=np.int64)
        w = np.log(inner.field("tokens").to_numpy(zero_copy_only=False)) + factor_l[at_l] + factor_t[at_t]
        top = np.full(batch.num_rows, -np.inf)
        np.maximum.at(top, row, w)
        w = np.exp(w - np.where(np.isfinite(top), top, 0.0)[row])
        own = np.bincount(row, weights=w, minlength=batch.num_rows)
        goal = batch.column("raw").to_numpy(zero_copy_only=False) / whole
        return row, at_l, at_t, inner, w * np.where(own > 0, goal / np.where(own > 0, own, 1), 0)[row]

    for _ in range(most_rounds if len(goal_l) and len(goal_t) else 0):
        now = factor_l, factor_t

        def add(batches, now=now):
            total = np.zeros(len(goal_l) * len(goal_t))
            for batch in batches:
                _, at_l, at_t, _, w = scaled(batch, *now)
                total += np.bincount(at_l * len(goal_t) + at_t, weights=w, minlength=len(total))
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["total"])

        part = rows.mapInArrow(add, "total array<double>").select(F.posexplode("total").alias("i", "v"))
        m = np.zeros(len(goal_l) * len(goal_t))
        for i, v in part.groupBy("i").agg(F.sum("v")).collect():  # languages x topics
            m[i] = v
        m = m.reshape(len(goal_l), len(goal_t))
        off = max(np.abs(m.sum(axis=1) - goal_l).max(), np.abs(m.sum(axis=0) - goal_t).max())
        if off <= tolerance:
            break
        # the two code sets may pull against each other: they are raked to the end on their own table before the next pass
        for _ in range(INNER_ROUNDS):
            pull_l = np.divide(goal_l, m.sum(axis=1), out=np.zeros_like(goal_l), where=m.sum(axis=1) > 0)
            m *= pull_l[:, None]
            pull_t = np.divide(goal_t, m.sum(axis=0), out=np.zeros_like(goal_t), where=m.sum(axis=0) > 0)
            m *= pull_t[None, :]
            with np.errstate(divide="ignore"):  # a value without a goal has weight 0
                factor_l, factor_t = factor_l + np.log(pull_l), factor_t + np.log(pull_t)
            if np.abs(m.sum(axis=1) - goal_l).max() <= tolerance / 10:
                break
    last = factor_l, factor_t

    def final(batches):
        for batch in batches:
            row, _, _, inner, w = scaled(batch, *last)
            yield pa.RecordBatch.from_arrays([batch.column("source").take(pa.array(row)), inner.field("lang"), inner.field("topic"), inner.field("tokens"),
                                              pa.array(w)], ["source", "lang", "topic", "tokens", "w"])

    return settled(rows.mapInArrow(final, "source string, lang string, topic int, tokens long, w double"), "raked")


def _rate(cells: DataFrame, share: float) -> float:
    """The rate at which ``sum(tokens * min(1, rate * w / tokens))`` is ``share`` of all tokens; by bisection on grids."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return 0.0
    low, high = 0.0, None
    top = cells.where("w > 0").agg(F.max(F.col("tokens") / F.col("w")), F.sum("tokens")).first()
    high, reachable = float(top[0] or 0.0), float(top[1] or 0.0)
    goal = min(share * total, reachable)
    for _ in range(5):
        grid = np.linspace(low, high, 65)
        got = cells.agg(*[F.sum(F.least(F.col("tokens").cast("double"), F.lit(float(g)) * F.col("w"))).alias(f"g{i}") for i, g in enumerate(grid)]).first()
        at = int(np.searchsorted(np.array(got, dtype=float), goal))
        low, high = float(grid[max(at - 1, 0)]), float(grid[min(at, 64)])
    return high


def chance(seed: int, *keys) -> Column:
    """A number from 0 to 1 by hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11) / F.lit(float(1 << 53))


def mixture(docs: DataFrame, targets: Mapping[str, Mapping] | None = None, share: float = 0.5, power: float = 0.5, topics: int = 8,
            seed: int = 7) -> DataFrame:
    """``doc_id``, ``source``, ``lang``, ``topic``, ``n_tokens``, ``prob``, ``weight``, ``selected``, ``t1``, ``t2`` of each row."""
    rows = profiled(docs, topics)
    cells = settled(rows.groupBy(*AXES).agg(F.sum("n_tokens").alias("tokens")), "cells")
    raked = rake(cells, targets, power)
    rate = _rate(raked, share)
    raw_p = F.lit(rate) * F.col("w") / F.col("tokens")
    chances = raked.select(*[F.col(a).alias(f"__{a}") for a in AXES], F.least(F.lit(1.0), raw_p).alias("p"), F.greatest(F.lit(1.0), raw_p).alias("over"))
    on = [F.col(a).eqNullSafe(F.col(f"__{a}")) for a in AXES]
    joined = rows.join(chances, on[0] & on[1] & on[2], "left")
    empty = F.col("n_tokens") == 0
    prob = F.when(empty, 1.0).otherwise(F.coalesce("p", F.lit(0.0)))
    weight = F.when(empty, 1.0).otherwise(F.coalesce("over", F.lit(1.0)))
    return joined.select("doc_id", *AXES, "n_tokens", prob.alias("prob"), weight.alias("weight"),
                         (chance(seed, "doc_id", "t1") < prob).alias("selected"), "t1", "t2")


def sampled(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``mix`` selected, all their columns, and ``mix_weight`` (in place of a column of that name)."""
    t1, t2, i, p1, p2, w = free(docs.columns, "__t1", "__t2", "__id", "__p1", "__p2", "__w")
    picked = mix.where("selected").groupBy("doc_id", "t1", "t2").agg(F.max("weight").alias(w)).select(
        F.col("doc_id").alias(i), F.col("t1").alias(p1), F.col("t2").alias(p2), w)
    own = docs.withColumns({t1: F.xxhash64("text"), t2: F.xxhash64(F.lit(1), F.col("text"))})
    on = (F.col("doc_id").cast("long").eqNullSafe(F.col(i))) & (F.col(t1) == F.col(p1)) & (F.col(t2) == F.col(p2))
    out = own.join(picked.hint("shuffle_hash"), on).withColumn("mix_weight", F.col(w))
    return out.select(*[c for c in docs.columns if c != "mix_weight"], "mix_weight")
