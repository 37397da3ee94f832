"""Approximate nearest neighbours: p-stable hashing whose neighbouring buckets are probed in order of success."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.llm.common import map_arrow
from lendreach.llm.vectors import answers, distinct_vectors, in_turns, matrix, query_vectors, usable
from lendreach.session import cut_lineage

ROWS = 16_384           # vectors that one task holds; hot buckets are dealt to several tasks
QUERY_ROWS = 256
QUERY_PIECE = 8_192     # queries that one task holds
WHOLE_BAND = 256        # a band of so few vectors is one bucket, visited by every query
SAMPLE_ROWS = 4_096     # at most so many vectors, of so many components together, go to the fit
SAMPLE_COMPONENTS = 4_000_000
SAMPLE_QUERIES = 128
GOAL = 0.95             # recall on the sample that a setting must reach


@dataclass(frozen=True)
class Probing:
    """Tables of ``hashes`` projections each, cut into cells of ``width`` times the band's largest norm; every
    query visits its own bucket and ``probes`` perturbed ones in each table and band."""
    tables: int = 5
    hashes: int = 4
    width: float = 1.4
    probes: int = 36
    seed: int = 5


def perturbations(hashes: int, probes: int) -> list[tuple[int, ...]]:
    """The likeliest perturbation sets, as places among the 2 * ``hashes`` sorted distances to cell borders.

    Sets are ranked by the expected sum of squared distances of uniformly placed queries; a set may not move
    one hash both ways.
    """
    m = hashes
    j = np.arange(1, 2 * m + 1)
    near = j * (j + 1) / (4.0 * (m + 1) * (m + 2))
    r = 2 * m + 1 - j
    far = 1 - r / (m + 1.0) + r * (r + 1) / (4.0 * (m + 1) * (m + 2))
    cost = np.where(j <= m, near, far)
    out, heap = [], [(cost[0], (0,))]
    while heap and len(out) < probes:
        score, places = heapq.heappop(heap)
        if all(2 * m - 1 - p not in places for p in places):
            out.append(places)
        last = places[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (score - cost[last] + cost[last + 1], (*places[:-1], last + 1)))
            heapq.heappush(heap, (score + cost[last + 1], (*places, last + 1)))
    return out


def _tables(p: Probing, dim: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(p.seed)
    return rng.standard_normal((p.tables, dim, p.hashes)), rng.random((p.tables, p.hashes))


def _bucket(cells: np.ndarray) -> np.ndarray:
    """64-bit key of integer cells (last axis: hashes)."""
    h = np.full(cells.shape[:-1], 0x9E3779B97F4A7C15, np.uint64)
    for i in range(cells.shape[-1]):
        h = (h ^ cells[..., i].astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
    return h.view(np.int64)


@dataclass(frozen=True)
class Bands:
    """Ranges of norms a factor of sqrt(2) wide, each an index of its own: number, largest norm, vectors in it."""
    name: np.ndarray
    top: np.ndarray
    rows: np.ndarray

    def whole(self) -> np.ndarray:
        return self.rows <= WHOLE_BAND


def norms(vecs: np.ndarray) -> np.ndarray:
    """Lengths of vectors that are not zero, at most the largest double."""
    most = np.abs(vecs).max(axis=1)
    with np.errstate(over="ignore"):
        return np.minimum(most * np.sqrt(((vecs / most[:, None]) ** 2).sum(axis=1)), np.finfo(float).max)


def band(norm: np.ndarray) -> np.ndarray:
    """Norms near 1, which are the commonest, stand in the middle of band 0."""
    return np.floor(2 * np.log2(norm) + 0.5).astype(np.int32)


def index_keys(vecs: np.ndarray, p: Probing, bands: Bands) -> np.ndarray:
    """Bucket of every vector in every table (rows x tables). A further component makes all norms of a band
    equal, so that its nearest point is the one of the largest inner product."""
    norm = norms(vecs)
    at = np.searchsorted(bands.name, band(norm))
    top = bands.top[at]
    full = np.concatenate([vecs / top[:, None], np.sqrt(np.maximum(1 - (norm / top) ** 2, 0.0))[:, None]], axis=1)
    a, b = _tables(p, full.shape[1])
    named = np.concatenate([np.zeros((len(vecs), p.hashes)), bands.name[at][:, None]], axis=1)
    split = ~bands.whole()[at]
    out = []
    for t in range(p.tables):
        named[split, :-1] = np.floor(full[split] @ a[t] / p.width + b[t])
        out.append(_bucket(named))
    return np.stack(out, axis=1)


def probe_keys(vecs: np.ndarray, p: Probing, bands: Bands) -> np.ndarray:
    """Buckets that every query visits (rows x tables x bands * (1 + probes)), likeliest first in each band."""
    full = np.concatenate([vecs / norms(vecs)[:, None], np.zeros((len(vecs), 1))], axis=1)
    a, b = _tables(p, full.shape[1])
    sets, m = perturbations(p.hashes, p.probes), p.hashes
    out = []
    for t in range(p.tables):
        at = full @ a[t] / p.width + b[t]
        cell = np.floor(at)
        order = np.argsort(np.concatenate([at - cell, 1 - (at - cell)], axis=1), axis=1)
        move = np.zeros((len(vecs), 1 + len(sets), m))
        rows = np.arange(len(vecs))
        for i, places in enumerate(sets, 1):
            for s in places:
                move[rows, i, order[:, s] % m] += np.where(order[:, s] < m, -1, 1)
        cells = cell[:, None, :] + move
        last = np.ones((*cells.shape[:2], 1))
        out.append(np.concatenate([_bucket(np.concatenate([cells * (not whole), last * name], axis=2))
                                   for name, whole in zip(bands.name, bands.whole(), strict=True)], axis=1))
    return np.stack(out, axis=1)


def visits(known: np.ndarray, asked: np.ndarray, who: np.ndarray, queries: int) -> np.ndarray:
    """Which of the sorted buckets ``known`` each query visits, from flat buckets and the query of each."""
    out = np.zeros((queries, len(known)), bool)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    hit = known[at] == asked
    out[who[hit], at[hit]] = True
    return out


def measured(sample: np.ndarray, p: Probing, bands: Bands, near: int) -> tuple[float, float]:
    """(recall of the ``near`` best, share of vectors scanned) when the sample's first rows search the sample."""
    asked = sample[:SAMPLE_QUERIES]
    n = len(asked)
    score = asked @ sample.T
    score[np.arange(n), np.arange(n)] = -np.inf
    best = np.argsort(-score, axis=1, kind="stable")[:, :near]
    have, want = index_keys(sample, p, bands), probe_keys(asked, p, bands)
    seen = np.zeros(score.shape, bool)
    for t in range(p.tables):
        known, place = np.unique(have[:, t], return_inverse=True)
        seen |= visits(known, want[:, t].ravel(), np.repeat(np.arange(n), want.shape[2]), n)[:, place]
    return float(np.take_along_axis(seen, best, 1).mean()), float(seen.mean())


def fitted(sample: np.ndarray, bands: Bands, n: int, k: int) -> tuple[Probing, float, float]:
    """(setting, recall, scanned share): the setting that scans least of the sample and reaches ``GOAL`` there.

    Of ``n`` vectors the sample holds a part, so of ``k`` neighbours it holds that part; where that is less than
    one, its nearest is farther than the true ones and the setting errs to the wide side. The larger the table,
    the nearer its neighbours and the narrower the cells that find them.
    """
    if len(sample) < 2:
        return Probing(), 1.0, 1.0
    near = min(len(sample) - 1, max(1, round(k * len(sample) / n)))
    tried = [(p, *measured(sample, p, bands, near)) for p in
             (Probing(hashes=h, width=w) for h in (3, 4, 6, 8, 10, 12) for w in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8))]
    good = [x for x in tried if x[1] >= GOAL]
    return min(good, key=lambda x: x[2]) if good else max(tried, key=lambda x: x[1])


def bands_of(groups: DataFrame) -> Bands:
    """The bands of the different vectors (column vec): at most some 4,300, as doubles have so many exponents."""
    def measure(batches):
        for b in batches:
            if len(b):
                norm = norms(matrix(b.column("vec")))
                yield pa.RecordBatch.from_arrays([pa.array(band(norm)), pa.array(norm)], ["band", "norm"])

    found = map_arrow(groups.select("vec"), measure, "band int, norm double").groupBy("band").agg(
        F.max("norm").alias("top"), F.count("*").alias("rows")).orderBy("band").collect()
    return Bands(np.array([r["band"] for r in found], np.int32), np.array([r["top"] for r in found], float),
                 np.array([r["rows"] for r in found], np.int64))


def sample_of(groups: DataFrame) -> np.ndarray:
    """At most ``SAMPLE_ROWS`` vectors and ``SAMPLE_COMPONENTS`` components, by the hash of their ids."""
    first = groups.select("vec").first()
    if first is None:
        return np.zeros((0, 0))
    rows = max(2, min(SAMPLE_ROWS, SAMPLE_COMPONENTS // len(first["vec"])))
    return np.array([r["vec"] for r in groups.select("rep", "vec").orderBy(F.xxhash64("rep"), "rep").limit(rows).collect()],
                    float)


def near_vectors(df: DataFrame, chosen: Column, k: int, key: str = "vec_id", vector: str = "embedding",
                 probing: Probing | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): ``k`` near vectors by inner product for the rows ``chosen`` (over ``id``).

    Vectors are split into bands of norms, each with an index scaled to its own largest norm, so that a few long
    vectors do not crowd all others into one bucket; small bands are visited whole. Without ``probing`` the
    setting is fitted on a bounded sample (``fitted``); every row is indexed. Equal vectors are hashed once.
    Buckets are dealt to tasks by (table, part of the buckets, part of the rows, part of the queries), the last
    two sized by counts, so a bucket of any size is whole but never in one task. Within a task the candidates of
    all probed buckets are scored exactly and the ``k + 1`` best are kept for each query; a query gets at most
    tables * bands * (1 + probes) such lists a part of rows. Queries that met fewer than ``k + 1`` different
    vectors, themselves included, are compared with all vectors in blocks, so each gets ``k`` rows or all there are.

    Zero vectors, vectors with anything null or non-finite, and vectors of another than the commonest length
    take no part; an empty table, or a query without another vector, gives no row.
    """
    rows = usable(df, key, vector).filter(F.exists("vec", lambda x: x != 0))
    groups = cut_lineage(distinct_vectors(rows, k), "vectors")
    once, members = query_vectors(rows, chosen)
    bands = bands_of(groups)
    n = int(bands.rows.sum())
    if probing is None:
        probing = fitted(sample_of(groups), bands, n, k)[0]
    parts = max(1, -(-n // ROWS))

    def spread_index(batches):
        for b in batches:
            if not len(b):
                continue
            keys = index_keys(matrix(b.column("vec")), probing, bands)
            for t in range(probing.tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b), t, np.int32)), pa.array((keys[:, t] % parts).astype(np.int32)),
                     pa.array(keys[:, t]), b.column("rep"), b.column("vec")], ["tab", "part", "bucket", "rep", "vec"])

    def spread_queries(batches):
        for whole in batches:
            for lo in range(0, len(whole), 512):
                b = whole.slice(lo, 512)
                keys = probe_keys(matrix(b.column("vec")), probing, bands)
                out = []
                for i, q in enumerate(b.column("qrep").to_pylist()):
                    for t in range(probing.tables):
                        mine = np.unique(keys[i, t])
                        for s in np.unique(mine % parts).tolist():
                            out.append((i, t, s, q, mine[mine % parts == s].tolist()))
                at, tab, part, qrep, buckets = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tab, pa.int32()), pa.array(part, pa.int32()), pa.array(buckets, pa.list_(pa.int64())),
                     pa.array(qrep, pa.int64()), b.column("vec").take(pa.array(at))],
                    ["tab", "part", "buckets", "qrep", "vec"])

    index = map_arrow(groups.select("rep", "vec"), spread_index,
                      "tab int, part int, bucket long, rep long, vec array<double>")
    sizes = index.groupBy("tab", "part").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("pieces"))
    index = index.join(sizes, ["tab", "part"]).withColumn(
        "piece", F.pmod(F.xxhash64("rep"), F.col("pieces")).cast("int")).drop("pieces")
    asked = map_arrow(once, spread_queries, "tab int, part int, buckets array<long>, qrep long, vec array<double>")
    asked = asked.join(sizes, ["tab", "part"]).withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
    place = ["tab", "part", "piece", "turn"]

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_best = [], []
        if len(left) and len(right):
            have, reps = matrix(left.column("vec")), left.column("rep").to_numpy()
            known, place = np.unique(left.column("bucket").to_numpy(), return_inverse=True)
            for lo in range(0, len(right), QUERY_ROWS):
                part = right.slice(lo, QUERY_ROWS)
                want = matrix(part.column("vec"))
                lists = part.column("buckets").combine_chunks()
                visited = visits(known, lists.flatten().to_numpy(),
                                 np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy()), len(part))
                score = np.where(visited[:, place], want @ have.T, -np.inf)
                top = np.argpartition(-score, k, axis=1)[:, :k + 1] if score.shape[1] > k + 1 else \
                    np.broadcast_to(np.arange(score.shape[1]), score.shape)
                cut = np.take_along_axis(score, top, 1).min(axis=1)
                for i, q in enumerate(part.column("qrep").to_pylist()):
                    # all that tie with the last, in one fixed order of addition
                    c = np.flatnonzero(score[i] >= cut[i] - 1e-9 * max(1.0, abs(cut[i]))) \
                        if np.isfinite(cut[i]) else np.flatnonzero(np.isfinite(score[i]))
                    if len(c):
                        exact = (have[c] * want[i]).sum(axis=1)
                        o = np.lexsort((reps[c], -exact))[:k + 1]
                        out_q.append(q)
                        out_best.append([{"minus": -s, "rep": r} for s, r in
                                         zip(exact[o].tolist(), reps[c[o]].tolist(), strict=True)])
        return pa.Table.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_best, BEST)], ["qrep", "best"])

    def best(index: DataFrame, asked: DataFrame) -> DataFrame:
        """(qrep, rep, score): the ``k + 1`` best vectors that each query meets."""
        have, want = in_turns(index, asked, ["tab", "part"], QUERY_PIECE)
        lists = have.groupBy(*place).cogroup(want.groupBy(*place)).applyInArrow(
            rank, "qrep long, best array<struct<minus:double,rep:long>>")
        merged = lists.groupBy("qrep").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(
            F.collect_list("best")))), 1, k + 1).alias("best"))
        return merged.select("qrep", F.explode("best").alias("b")).select(
            "qrep", F.col("b.rep").alias("rep"), (-F.col("b.minus")).alias("score"))

    found = cut_lineage(best(index, asked), "near")
    met = found.groupBy("qrep").count().filter(F.col("count") >= min(k + 1, n))
    short = cut_lineage(once.join(met, "qrep", "left_anti"), "short")
    if not short.isEmpty():
        blocks = groups.select(F.lit(0).alias("tab"), F.pmod(F.xxhash64("rep"), F.lit(parts)).cast("int").alias("part"),
                               F.lit(0).alias("piece"), F.lit(0).cast("long").alias("bucket"), "rep", "vec")
        every = short.select(F.lit(0).alias("tab"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                             F.lit(0).alias("piece"), F.array(F.lit(0).cast("long")).alias("buckets"), "qrep", "vec")
        found = found.join(short, "qrep", "left_anti").unionByName(best(blocks, every))
    return answers(found, groups, members, k)


BEST = pa.list_(pa.struct([("minus", pa.float64()), ("rep", pa.int64())]))
