"""Near-duplicate embeddings by dual traversal of cover trees.

Unit vectors of one label are dealt into chunks of bounded size. Each chunk gets a cover tree: nested
levels whose radii halve, every node with the distance to its farthest member. For two trees (or one with
itself), pairs of nodes go down together and are dropped as soon as the distance of the centres less both
covering radii exceeds the threshold; members of the remaining pairs of leaves are compared exactly in
double precision. A chunk pair reports the number of links of each vector and the links of a spanning
forest only, so a group of copies is never written out as pairs.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.links import components
from marketlens.session import settle

CHUNK = 2048
ROUNDING = 1e-6


class Level(NamedTuple):
    """Nodes of a level: centre (row), parent (node of the level above), covering radius; and the node of each row."""
    centre: np.ndarray
    parent: np.ndarray
    radius: np.ndarray
    node: np.ndarray


def build(x: np.ndarray, least: float) -> list[Level]:
    """Levels from one root down to nodes of radius `least` at most; centres of a level are centres below."""
    n = len(x)
    far = lambda rows, c: np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x[rows] @ x[c])))
    levels = [Level(np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([far(np.arange(n), 0).max()]), np.zeros(n, np.int64))]
    radius = 2.0
    while radius > least:
        radius /= 2
        above = levels[-1]
        centre, parent, reach, node = [], [], [], np.empty(n, np.int64)
        order = np.argsort(above.node, kind="stable")
        cut = np.searchsorted(above.node[order], np.arange(len(above.centre) + 1))
        for p in range(len(above.centre)):
            left = order[cut[p]:cut[p + 1]]
            c = above.centre[p]
            while len(left):
                d = far(left, c)
                inside = d <= radius
                inside[left == c] = True
                node[left[inside]] = len(centre)
                centre.append(c)
                parent.append(p)
                reach.append(d[inside].max())
                left = left[~inside]
                if len(left):
                    c = left[0]
        levels.append(Level(np.array(centre), np.array(parent), np.array(reach), node))
        if len(centre) == n:
            break
    return levels


def close_pairs(x: np.ndarray, a: list[Level], y: np.ndarray, b: list[Level], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x and of y with at least this cosine."""
    apart = math.sqrt(max(0.0, 2.0 - 2.0 * cosine)) + ROUNDING
    alive = np.ones((1, 1), bool)
    for k in range(max(len(a), len(b))):
        p, q = a[min(k, len(a) - 1)], b[min(k, len(b) - 1)]
        if k:
            rows = p.parent if k < len(a) else np.arange(len(p.centre))
            columns = q.parent if k < len(b) else np.arange(len(q.centre))
            alive = alive[rows][:, columns]
        i, j = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        if not len(i) or not len(j):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x[p.centre[i]] @ y[q.centre[j]].T)))
        keep = d - p.radius[i][:, None] - q.radius[j][None, :] <= apart
        alive[np.ix_(i, j)] &= keep
    left, right = [], []
    rows_of, columns_of = _members(a[-1]), _members(b[-1])
    for i in np.flatnonzero(alive.any(1)):
        m = rows_of[i]
        other = np.concatenate([columns_of[j] for j in np.flatnonzero(alive[i])])
        s, t = np.nonzero(x[m] @ y[other].T >= cosine)
        left.append(m[s])
        right.append(other[t])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _members(level: Level) -> list[np.ndarray]:
    order = np.argsort(level.node, kind="stable")
    return np.split(order, np.searchsorted(level.node[order], np.arange(1, len(level.centre))))


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that each of n rows reaches by links."""
    low = np.arange(n)
    while True:
        least = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _pack(levels: list[Level]) -> bytes:
    parts = [np.array([len(levels)], np.int64)]
    for v in levels:
        parts += [np.array([len(v.centre), len(v.node)], np.int64), v.centre, v.parent, v.radius.view(np.int64), v.node]
    return np.concatenate(parts).tobytes()


def _unpack(data: bytes) -> list[Level]:
    flat, at, out = np.frombuffer(data, np.int64), 1, []
    for _ in range(flat[0]):
        k, n = flat[at], flat[at + 1]
        at += 2
        out.append(Level(flat[at:at + k], flat[at + k:at + 2 * k], flat[at + 2 * k:at + 3 * k].view(np.float64), flat[at + 3 * k:at + 3 * k + n]))
        at += 3 * k + n
    return out


def _plant(cosine: float):
    least = math.sqrt(max(0.0, 2.0 - 2.0 * cosine)) / 2

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        x = np.stack([np.array(v, float) for v in table.column("vector").to_pylist()])
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        first = table.slice(0, 1)
        return pa.table({c: first.column(c) for c in ("label", "size", "chunks", "chunk")} | {
            "ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()),
            "vectors": pa.array([x.tobytes()], pa.binary()), "tree": pa.array([_pack(build(x, max(least, 1e-4)))], pa.binary())})
    return run


def _meet(cosine: float):
    """Per vector of a chunk pair: number of links, and the smallest vector it reaches there."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        ids = [np.frombuffer(v, np.int64) for v in table.column("ids").to_pylist()]
        x = [np.frombuffer(v, float).reshape(len(i), -1) for v, i in zip(table.column("vectors").to_pylist(), ids)]
        trees = [_unpack(v) for v in table.column("tree").to_pylist()]
        i, j = close_pairs(x[0], trees[0], x[-1], trees[-1], cosine)
        if len(ids) == 1:
            i, j = i[i < j], j[i < j]
        every = np.concatenate(ids)
        j = j + (len(ids[0]) if len(ids) == 2 else 0)
        count = np.bincount(i, minlength=len(every)) + np.bincount(j, minlength=len(every))
        order = np.argsort(every)
        back = np.empty(len(every), np.int64)
        back[order] = np.arange(len(every))
        low = every[order][_forest(len(every), back[i], back[j])][back]
        some = count > 0
        return pa.table({"vec_id": every[some], "n": count[some].astype(np.int64), "low": low[some]})
    return run


def near_embeddings(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
                    cosine: float = 0.98, chunk: int = CHUNK) -> DataFrame:
    """vec_id, n_links, component_id and kept of each vector; other columns are not looked at.

    Only vectors with equal labels and lengths are compared. A null label, and a vector that is null,
    empty, zero or holds null or non-finite components, links with nothing. Rows that repeat an id are
    one vector: the least label and vector count. Rows without an id stay one by one, unlinked and kept.
    An empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("string").alias("label"),
                          F.col(vector_column).cast("array<double>").alias("vector"))
    known = settle(rows.where("vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("v")).select(
        "vec_id", "v.label", "v.vector"))
    sound = (F.size("vector") > 0) & F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(
        "vector", lambda c: c != 0)
    usable = known.where(F.col("label").isNotNull() & F.col("vector").isNotNull()).where(sound).withColumn("size", F.size("vector"))
    amount = usable.groupBy("label", "size").agg(F.ceil(F.count("*") / F.lit(chunk)).cast("int").alias("chunks"))
    dealt = usable.join(amount, ["label", "size"]).withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int"))
    trees = settle(dealt.groupBy("label", "size", "chunk").applyInArrow(
        _plant(cosine), "label string, size int, chunks int, chunk int, ids binary, vectors binary, tree binary"))
    pairs = trees.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn(
        "low", F.least("chunk", "other")).withColumn("high", F.greatest("chunk", "other"))
    met = settle(pairs.select("label", "size", "low", "high", "chunk", "ids", "vectors", "tree").groupBy("label", "size", "low", "high").applyInArrow(
        _meet(cosine), "vec_id long, n long, low long"))
    merged = components(met.select(F.col("vec_id").alias("a"), F.col("low").alias("b"))).withColumnRenamed("node", "vec_id")
    links = met.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    result = known.select("vec_id").join(links, "vec_id", "left").join(merged, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    lone = rows.where("vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    return result.union(lone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
