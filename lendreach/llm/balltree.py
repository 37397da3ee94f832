"""Exact top-k inner products: ball trees per shard, searched best bound first under a shared kth score."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.llm.common import map_arrow
from lendreach.llm.vectors import answers, distinct_vectors, matrix, query_vectors, usable

LEAF = 128
SHARD_ROWS = 8_192      # vectors a shard is made for; fuller shards are dealt to several tasks
MAX_SHARDS = 1_024      # shard centres and radii are broadcast: at most this many rows


class BallTree:
    """Points in nested balls: a node has a centre, a radius and either two children or a run of rows."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.centre, self.radius, self.kids, self.rows = [], [], [], []
        self.points = points
        self._grow(0, len(points))
        self.points = points[self.order]
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)

    def _grow(self, lo: int, hi: int) -> None:
        stack = [(lo, hi, None)]
        while stack:
            lo, hi, parent = stack.pop()
            p = self.points[self.order[lo:hi]]
            c = p.mean(axis=0)
            gap = np.sqrt(((p - c) ** 2).sum(axis=1))
            at = len(self.centre)
            self.centre.append(c)
            self.radius.append(float(gap.max()))
            self.kids.append(None)
            self.rows.append((lo, hi))
            if parent is not None:
                self.kids[parent] = (*(self.kids[parent] or ()), at)
            if hi - lo > LEAF and gap.max() > 0:
                a = p[gap.argmax()]
                b = p[((p - a) ** 2).sum(axis=1).argmax()]
                side = np.argsort(p @ (b - a), kind="stable")
                self.order[lo:hi] = self.order[lo:hi][side]
                mid = (lo + hi) // 2
                stack += [(mid, hi, at), (lo, mid, at)]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Queries x nodes: no point of the node has a larger inner product."""
        reach = np.linalg.norm(queries, axis=1)[:, None] * self.radius[None, :]
        return slack(queries @ self.centre.T + reach)

    def search(self, query: np.ndarray, bound: np.ndarray, ids: np.ndarray, k: int, floor: float):
        """The ``k`` best (score, id) not under ``floor``, nodes taken by falling bound; ties to the lesser id."""
        best: list[tuple[float, int]] = []          # heap of (score, -id): the worst on top
        heap = [(-bound[0], 0)]
        while heap:
            b, node = heapq.heappop(heap)
            if -b < floor:
                break
            if self.kids[node]:
                for kid in self.kids[node]:
                    heapq.heappush(heap, (-bound[kid], kid))
                continue
            lo, hi = self.rows[node]
            score = self.points[lo:hi] @ query
            for i in np.flatnonzero(score >= floor):
                item = (float(score[i]), -int(ids[self.order[lo + i]]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                floor = max(floor, best[0][0])
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _stacked(rows: list) -> np.ndarray:
    return np.array(rows, float) if rows else np.zeros((0, 0))


def slack(bound: np.ndarray) -> np.ndarray:
    """A bound with room for rounding."""
    return bound + 1e-9 * np.abs(bound) + 1e-6


def exact_top(df: DataFrame, chosen: Column, k: int, key: str = "vec_id", vector: str = "embedding",
              scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of floor(scale * x) for the rows
    ``chosen`` (over ``id``), exactly; ties to the lesser id.

    Vectors are dealt to the nearest of at most ``MAX_SHARDS`` pivots (a bounded sample; it decides only who
    is with whom). First every query searches its most promising shard, which gives a kth score that holds for
    all; then it visits just the shards whose ball can beat that score, and within a shard the nodes whose ball
    can. Equal vectors are searched once. Vectors with anything null or non-finite take no part; scores are
    exact while sums stay under 2^53. An empty table, or a query without another vector, gives no row.
    """
    rows = usable(df, key, vector).withColumn(
        "vec", F.transform("vec", lambda x: F.floor(x * F.lit(float(scale))).cast("double")))
    groups = distinct_vectors(rows, k)
    once, members = query_vectors(rows, chosen)
    spark = df.sparkSession
    n = rows.count()
    shards = max(1, min(MAX_SHARDS, -(-n // SHARD_ROWS)))
    pivots = [r["vec"] for r in groups.select("rep", "vec").orderBy(F.xxhash64("rep"), "rep").limit(shards).collect()]
    centre = spark.sparkContext.broadcast(_stacked(pivots))

    def deal(batches):
        for b in batches:
            if not len(b):
                continue
            c, v = centre.value, matrix(b.column("vec"))
            near = ((c * c).sum(1)[None, :] - 2 * v @ c.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near.astype(np.int32))], ["rep", "vec", "shard"])

    dealt = map_arrow(groups.select("rep", "vec"), deal, "rep long, vec array<double>, shard int")
    sizes = dealt.groupBy("shard").agg(F.ceil(F.count("*") / (2 * SHARD_ROWS)).cast("int").alias("pieces"))
    points = dealt.join(sizes, "shard").withColumn(
        "piece", F.pmod(F.xxhash64("rep"), F.col("pieces")).cast("int")).drop("pieces")

    def ball(batch: pa.Table) -> pa.Table:
        v = matrix(batch.column("vec"))
        c = v.mean(axis=0)
        return pa.Table.from_arrays(
            [batch.column("shard").slice(0, 1), batch.column("piece").slice(0, 1), pa.array([c.tolist()]),
             pa.array([float(np.sqrt(((v - c) ** 2).sum(axis=1)).max())])], ["shard", "piece", "centre", "radius"])

    balls = points.groupBy("shard", "piece").applyInArrow(
        ball, "shard int, piece int, centre array<double>, radius double")
    # pieces of a shard are even shares of it, so one ball round them all serves: at most MAX_SHARDS rows
    tops = balls.groupBy("shard").agg(F.min_by("centre", "piece").alias("centre"),
                                      F.collect_list(F.struct("centre", "radius")).alias("parts"))
    around = F.array_max(F.transform("parts", lambda p: p["radius"] + F.sqrt(F.aggregate(
        F.zip_with(p["centre"], "centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x))))
    found = tops.select("shard", "centre", around.alias("radius")).orderBy("shard").collect()
    roots = spark.sparkContext.broadcast((
        np.array([r["shard"] for r in found], np.int32), _stacked([r["centre"] for r in found]),
        np.array([r["radius"] for r in found], float)))

    def home(batches):
        names, c, _ = roots.value
        for b in batches:
            if not len(b):
                continue
            at = names[(matrix(b.column("vec")) @ c.T).argmax(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(at.astype(np.int32)), pa.array(np.full(len(b), -np.inf))],
                ["qrep", "vec", "shard", "floor"])

    def visit(batches):
        names, c, r = roots.value
        for whole in batches:
            for lo in range(0, len(whole), 1024):
                b = whole.slice(lo, 1024)
                q, floor = matrix(b.column("vec")), b.column("floor").to_numpy()
                bound = slack(q @ c.T + np.linalg.norm(q, axis=1)[:, None] * r[None, :])
                i, s = np.nonzero(bound >= floor[:, None])
                yield pa.RecordBatch.from_arrays(
                    [b.column("qrep").take(pa.array(i)), b.column("vec").take(pa.array(i)), pa.array(names[s]),
                     pa.array(floor[i])], ["qrep", "vec", "shard", "floor"])

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if len(left) and len(right):
            tree, ids = BallTree(matrix(left.column("vec"))), left.column("rep").to_numpy()
            for lo in range(0, len(right), 512):
                part = right.slice(lo, 512)
                q = matrix(part.column("vec"))
                bound = tree.bounds(q)
                for i, (name, floor) in enumerate(zip(part.column("qrep").to_pylist(),
                                                      part.column("floor").to_pylist(), strict=True)):
                    for s, rep in tree.search(q[i], bound[i], ids, k + 1, floor):
                        out[0].append(name)
                        out[1].append(rep)
                        out[2].append(int(s))
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in out], ["qrep", "rep", "score"])

    asked_at = "qrep long, vec array<double>, shard int, floor double"
    # a floor is good from any part of the data, so the first piece of the home shard is enough
    first = map_arrow(once, home, asked_at).withColumn("piece", F.lit(0))
    start = (points.groupBy("shard", "piece").cogroup(first.groupBy("shard", "piece"))
             .applyInArrow(look, "qrep long, rep long, score long"))
    floors = (start.groupBy("qrep").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("floor"))
              .filter(F.col("n") > k).drop("n"))
    asked = map_arrow(once.join(floors, "qrep", "left").select(
        "qrep", "vec", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")), visit, asked_at)
    asked = asked.join(sizes, "shard").withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
    hits = (points.groupBy("shard", "piece").cogroup(asked.groupBy("shard", "piece"))
            .applyInArrow(look, "qrep long, rep long, score long"))
    return answers(hits, groups, members, k)
