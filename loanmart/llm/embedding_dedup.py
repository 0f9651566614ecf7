"""Embedding near copies: PCA-ordered tiled comparison with exact results.

Method: vectors of length 1 are turned by the eigenvectors of their second moments, largest first, which keeps cosines.
A product then gathers leading coordinates first; what is still missing is at most the product of the two suffix norms,
so a comparison stops as soon as the limit is out of reach. The same bound prunes whole tiles: a tree over the leading
coordinates (split points from a bounded sample, so at most ``SAMPLE`` / ``LEAST`` leaves; every vector indexed) gives
leaves, and two leaves meet only if their boxes and largest suffix norms allow the limit. Leaves are cut into blocks of
about ``BLOCK`` vectors whatever the data; a pair of blocks is a tile. Tiles are made by Spark, the driver holds split
points and axes only. A tile is one unit of work and returns link counts and a spanning forest, never the pairs.
Survivors are verified in double precision on the vectors as given. Equal vectors are one class with a count.

Vectors of each length are compared among themselves; lengths of at most ``BLOCK`` different vectors are a tile each.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing, and are their
own component. Vectors of different lengths do not link. A row with a null ``vec_id`` takes part like any other, counts
for its neighbours, has its component's smallest id and is never kept. Every row gets its row; rows that repeat an id are
vectors of their own that share the id. Other columns are not read. No rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.graph import components
from loanmart.session import settled

#: Vectors in a block, coordinates in a step and in a leaf's box, vectors read for the tree's split points, and least such
#: vectors for a leaf.
BLOCK, STEP, BOX, SAMPLE, LEAST = 4096, 16, 8, 20_000, 8
_SLACK = 1e-9


def _cleaned(batches):
    """Bytes of each usable vector in double precision; null otherwise."""
    for batch in batches:
        out, size = [], []
        column = batch.column("embedding")
        for v in column:
            x = None
            if v.is_valid and len(v):
                a = v.values
                if a.null_count == 0:
                    x = a.to_numpy(zero_copy_only=False).astype("<f8")
                    if not np.isfinite(x).all() or not x.any():
                        x = None
            out.append(None if x is None else x.tobytes())
            size.append(0 if x is None else len(x))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary()), pa.array(size, pa.int32())], ["vec_id", "x", "d"])


def _units(column, d: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(column), dtype="<f8").reshape(-1, d)
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x, scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def principal_axes(classes: DataFrame, d: int) -> np.ndarray:
    """Eigenvectors of the second moments as columns, largest first; tasks send d x d numbers each."""

    def add(batches):
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                u = _units(batch.column("x").to_pylist(), d)[1]
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array(total.tolist())], ["i", "r"])

    parts = classes.select("x").mapInArrow(add, "i int, r array<double>").select("i", F.posexplode("r").alias("j", "v"))
    m = np.zeros((d, d))
    for i, j, v in parts.groupBy("i", "j").agg(F.sum("v")).collect():
        m[i, j] = v
    return np.linalg.eigh((m + m.T) / 2)[1][:, ::-1].copy()


def _tree(lead: np.ndarray, leaves: int) -> list[tuple[int, float]]:
    """Splits (coordinate, value) of a complete binary tree in heap order."""
    splits: list[tuple[int, float]] = []
    level = [lead]
    while len(level) < leaves:
        below = []
        for part in level:
            axis = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if len(part) else 0
            at = float(np.median(part[:, axis])) if len(part) else 0.0
            splits.append((axis, at))
            below += [part[part[:, axis] <= at], part[part[:, axis] > at]]
        level = below
    return splits


def _leaf(lead: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(lead), dtype=np.int64)
    axis, at = (np.array([s[i] for s in splits]) for i in (0, 1)) if splits else (None, None)
    depth = (len(splits) + 1).bit_length() - 1
    for _ in range(depth):
        node = 2 * node + 1 + (lead[np.arange(len(lead)), axis[node].astype(int)] > at[node])
    return node - len(splits)


def _links(y1, y2, s1, s2, u1, u2, limit: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine ``limit`` or more; ``s1[k]`` are the norms of what is left after step k."""
    d = y1.shape[1]
    got = y1[:, :STEP] @ y2[:, :STEP].T
    a, b = np.nonzero(got + np.outer(s1[0], s2[0]) >= limit - _SLACK)
    if same:
        a, b = a[a < b], b[a < b]
    part = got[a, b]
    for k, at in enumerate(range(STEP, d, STEP), 1):
        if not len(a):
            break
        part = part + np.einsum("ij,ij->i", y1[a, at:at + STEP], y2[b, at:at + STEP])
        on = part + s1[k][a] * s2[k][b] >= limit - _SLACK
        a, b, part = a[on], b[on], part[on]
    sure = np.einsum("ij,ij->i", u1[a], u2[b]) >= limit
    return a[sure], b[sure]


def _stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable by links."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        fresh = label.copy()
        np.minimum.at(fresh, a, low)
        np.minimum.at(fresh, b, low)
        fresh = fresh[fresh]
        if (fresh == label).all():
            break
        label = fresh
    return label


def _tile(axes: np.ndarray | None, limit: float, part: int = 512):
    """Counts and forest of one tile; without ``axes`` coordinates stay as they are."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        d = len(rows["x"].iloc[0]) // 8
        rows = rows.sort_values("block", kind="stable")
        blocks = rows["block"].to_numpy()
        cut = int(np.searchsorted(blocks, blocks[0], side="right"))
        same = cut == len(blocks)
        if same and rows["t1"].iloc[0] != rows["t2"].iloc[0]:
            return pd.DataFrame({"cid": [], "linked": [], "star": []}).astype("int64")
        u = _units(rows["x"].tolist(), d)[1]
        y = u if axes is None else u @ axes
        left = np.cumsum((y * y)[:, ::-1], axis=1)[:, ::-1]
        norms = [np.sqrt(left[:, at]) if at < d else np.zeros(len(y)) for at in range(STEP, d + STEP, STEP)]
        m, cid = rows["m"].to_numpy(), rows["cid"].to_numpy()
        linked, ends_a, ends_b = np.zeros(len(y), dtype=np.int64), [], []
        firsts = range(0, len(y) if same else cut, part)
        for i in firsts:
            i2 = min(i + part, len(y) if same else cut)
            for j in range(i if same else cut, len(y), part):
                j2 = min(j + part, len(y))
                a, b = _links(y[i:i2], y[j:j2], [s[i:i2] for s in norms], [s[j:j2] for s in norms], u[i:i2], u[j:j2], limit, same and i == j)
                if not len(a):
                    continue
                np.add.at(linked, a + i, m[b + j])
                np.add.at(linked, b + j, m[a + i])
                own = np.concatenate([np.arange(i, i2), np.arange(j, j2)])
                star = _stars(len(own), a, b + (i2 - i))
                far = np.flatnonzero(star != np.arange(len(own)))
                ends_a.append(own[far])
                ends_b.append(own[star[far]])
        star = _stars(len(y), np.concatenate(ends_a), np.concatenate(ends_b)) if ends_a else np.arange(len(y))
        hit = np.flatnonzero(linked)
        return pd.DataFrame({"cid": cid[hit], "linked": linked[hit], "star": cid[star[hit]]})

    return run


def _tiles(boxes: DataFrame, leaves: int, width: int, limit: float) -> DataFrame:
    """``t1``, ``t2``: blocks (leaf:part) that may hold a link. ``boxes`` has a row for each of at most ``leaves`` leaves."""
    a, b = (boxes.select(*[F.col(c).alias(f"{side}_{c}") for c in boxes.columns]) for side in "ab")
    corners = [F.greatest(*[F.col(f"a_{x}{k}") * F.col(f"b_{y}{k}") for x in ("lo", "hi") for y in ("lo", "hi")]) for k in range(width)]
    most = sum(corners, start=F.col("a_rest") * F.col("b_rest"))
    met = a.withColumn("b_leaf", F.explode(F.sequence("a_leaf", F.lit(leaves - 1).cast("long")))).join(b, "b_leaf").where(most >= limit - _SLACK)
    # many parts of one leaf are dealt out before they meet
    firsts = met.select("a_leaf", "b_leaf", "b_parts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("a_parts") - 1)).alias("p")).repartition("a_leaf", "b_leaf", "p")
    low = F.when(F.col("a_leaf") == F.col("b_leaf"), F.col("p")).otherwise(0)
    both = firsts.select("a_leaf", "b_leaf", "p", F.explode(F.sequence(low, F.col("b_parts") - 1)).alias("q"))
    return both.select(F.concat_ws(":", "a_leaf", "p").alias("t1"), F.concat_ws(":", "b_leaf", "q").alias("t2"))


def _found(classes: DataFrame, d: int, total: int, limit: float, block: int) -> DataFrame:
    """``cid``, ``linked``, ``star`` of the ``total`` classes of length ``d``, by tiles."""
    axes = principal_axes(classes, d)
    some = classes.orderBy(F.xxhash64("x"), "cid").limit(SAMPLE).select("x").collect()
    leaves = 1
    while leaves * block < total and leaves * 2 * LEAST <= SAMPLE:
        leaves *= 2
    splits = _tree((_units([bytes(r.x) for r in some], d)[1] @ axes)[:, :BOX], leaves)
    width = min(BOX, d)

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _units(batch.column("x").to_pylist(), d)[1] @ axes
            rest = np.sqrt(np.maximum((y[:, width:] ** 2).sum(axis=1), 0))
            lead = [pa.array(y[:, k]) for k in range(width)]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), batch.column("m"), batch.column("x"), pa.array(_leaf(y[:, :width], splits)), pa.array(rest), *lead],
                                             ["cid", "m", "x", "leaf", "rest", *(f"y{k}" for k in range(width))])

    schema = "cid long, m long, x binary, leaf long, rest double, " + ", ".join(f"y{k} double" for k in range(width))
    placed = settled(classes.select("cid", "m", "x").mapInArrow(place, schema), "placed")
    # one row for each leaf
    boxed = placed.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("long").alias("parts"), F.max("rest").alias("rest"),
                                       *[f(f"y{k}").alias(f"{g}{k}") for k in range(width) for f, g in ((F.min, "lo"), (F.max, "hi"))])
    boxes = settled(boxed, "boxes")
    blocked = placed.select("cid", "m", "x", "leaf").join(boxes.select("leaf", "parts"), "leaf").select(
        "cid", "m", "x", F.concat_ws(":", "leaf", F.pmod(F.xxhash64("cid"), F.col("parts"))).alias("block"))
    pairs = _tiles(boxes, leaves, width, limit)
    sides = pairs.select("t1", "t2", F.explode(F.array_distinct(F.array("t1", "t2"))).alias("block"))
    return blocked.join(sides, "block").groupBy("t1", "t2").applyInPandas(_tile(axes, limit), "cid long, linked long, star long")


def embedding_components(vectors: DataFrame, limit: float = 0.9, block: int = BLOCK) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of each row of ``vectors`` (``vec_id``, ``embedding``)."""
    own = vectors.select(F.col("vec_id").cast("long"), "embedding")
    clean = settled(own.mapInArrow(_cleaned, "vec_id long, x binary, d int"), "vectors")
    alone = clean.where("d = 0").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    grouped = clean.where("d > 0").groupBy("d", "x").agg(F.count("*").alias("m"), F.min("vec_id").alias("low"))
    classes = settled(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    # one row for each length
    large = {r.d: r.n for r in classes.groupBy("d").agg(F.count("*").alias("n")).where(F.col("n") > block).collect()}
    few = classes.where(~F.col("d").isin(list(large))).select("cid", "m", "x", "d", F.lit("0").alias("block"), F.lit("0").alias("t1"), F.lit("0").alias("t2"))
    found = few.groupBy("d").applyInPandas(_tile(None, limit), "cid long, linked long, star long")
    for d, total in sorted(large.items()):
        found = found.unionByName(_found(classes.where(F.col("d") == d), d, total, limit, block))
    found = settled(found, "links")
    roots = components(found.select(F.col("cid").alias("a"), F.col("star").alias("b")))
    counts = found.groupBy("cid").agg(F.sum("linked").alias("linked"))
    facts = classes.select("cid", "x", "m", "low").join(counts, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    facts = settled(facts.select("x", F.coalesce("root", "cid").alias("root"), "low", (F.col("m") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "facts")
    lows = facts.groupBy("root").agg(F.min("low").alias("component_id"))
    whole = clean.where("d > 0").join(facts.join(lows, "root").select("x", "n_links", "component_id"), "x")
    named = whole.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    return named.unionByName(alone)
