"""Whitening of embeddings: exact integer moments, leading components by slicing the spectrum of the covariance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendreach.llm.common import map_arrow
from lendreach.llm.vectors import finite, matrix
from lendreach.session import cut_lineage

SCALE, SHIFT = 1024, 100_000
WIDEST = 2**42          # scaled entries beyond this are held there: their squares fit no long
ROWS = 4_096            # rows multiplied at once
LIMBS, BITS = 3, 40     # exact sums travel as three longs of 40 bits
SALTS = 64              # sums of many tasks meet in two steps
EPS = np.finfo(float).eps


# ---- spectrum --------------------------------------------------------------------------------------

def below(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``a`` lie under ``shift``: the negative pivots of the pivoted
    LDL' factorisation of a - shift I (Sylvester's law of inertia)."""
    m = a - shift * np.eye(len(a))
    alpha, negative, k, n = (1 + 17**0.5) / 8, 0, 0, len(a)

    def swap(i: int, j: int) -> None:
        if i != j:
            m[[i, j]] = m[[j, i]]
            m[:, [i, j]] = m[:, [j, i]]

    while k < n:
        column = np.abs(m[k + 1:, k])
        most = column.max() if len(column) else 0.0
        size = 1
        if abs(m[k, k]) < alpha * most:
            r = k + 1 + int(column.argmax())
            other = np.abs(m[k:, r])
            other[r - k] = 0.0
            reach = other.max()
            if abs(m[k, k]) * reach < alpha * most * most:
                if abs(m[r, r]) >= alpha * reach:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    size = 2
        rest = slice(k + size, n)
        if size == 1:
            d = m[k, k]
            negative += d < 0
            if d != 0:
                m[rest, rest] -= np.outer(m[rest, k], m[rest, k] / d)
        else:           # a block of two of opposite signs
            d, e = m[k:k + 2, k:k + 2].copy(), m[rest, k:k + 2].copy()
            negative += int((np.linalg.eigvalsh(d) < 0).sum())
            m[rest, rest] -= e @ np.linalg.solve(d, e.T)
        k += size
    return negative


class Slices:
    """Counts of eigenvalues above chosen points, halved until one eigenvalue stands alone."""

    def __init__(self, a: np.ndarray):
        self.a = a
        self.top = float(np.abs(a).sum(axis=1).max())
        self.least = max(8 * len(a) * EPS * self.top, np.finfo(float).tiny)
        self.seen = {-self.least: len(a), self.top + self.least: 0}

    def above(self, at: float) -> int:
        if at not in self.seen:
            self.seen[at] = len(self.a) - below(self.a, at)
        return self.seen[at]

    def around(self, i: int) -> tuple[float, float]:
        """The narrowest known interval with the i-th largest eigenvalue."""
        return (max(x for x, c in self.seen.items() if c >= i), min(x for x, c in self.seen.items() if c < i))


def _clean(v: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for f in found:
            v = v - f * (f @ v)
    return v / np.linalg.norm(v)


def _inverse(a: np.ndarray, shift: float, v: np.ndarray, least: float) -> np.ndarray:
    for nudge in (0.0, least, 3 * least):
        try:
            w = np.linalg.solve(a - (shift + nudge) * np.eye(len(a)), v)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(w).all() and np.abs(w).max() > 0:
            return w / np.abs(w).max()
    return v


def _quotient(a: np.ndarray, shift: float, found: list[np.ndarray], start: np.ndarray, least: float):
    """(eigenvalue, vector, residual) by Rayleigh quotient iteration, cleaned of the vectors found before."""
    v = _clean(start, found)
    for _ in range(2):
        v = _clean(_inverse(a, shift, v, least), found)
    best = None
    for _ in range(8):
        rho = float(v @ a @ v)
        miss = float(np.linalg.norm(a @ v - rho * v))
        if best is not None and miss >= best[2] / 2:
            break
        best = rho, v, miss
        v = _clean(_inverse(a, rho, v, least), found)
    return best


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of the symmetric ``a``, falling, and their unit vectors as rows.

    Counts halve the axis until the i-th eigenvalue stands alone, Rayleigh quotients finish it, and two more
    counts just beside it certify that it is the i-th. Eigenvalues closer than rounding are one cluster: any
    orthonormal vectors of its space serve. The entry largest in size is positive in every vector.
    """
    k, slices, found, values = min(k, len(a)), Slices(a), [], []
    start = np.random.default_rng(7).standard_normal((k, len(a)))
    while len(found) < k:
        i = len(found) + 1
        lo, hi = slices.around(i)
        one = slices.above(lo) == i and slices.above(hi) == i - 1
        narrow = hi - lo <= 4 * slices.least
        if one or narrow:
            rho, v, miss = _quotient(a, (lo + hi) / 2, found, start[i - 1], slices.least)
            side = slices.least + 2 * miss
            sure = lo - side <= rho <= hi + side and slices.above(rho - side) >= i > slices.above(rho + side)
            if narrow or sure and miss <= slices.least * 4:
                found.append(v if v[np.abs(v).argmax()] > 0 else -v)
                values.append(rho)
                continue
        slices.above((lo + hi) / 2)
    return np.array(values), np.array(found).reshape(k, len(a))


# ---- exact sums ------------------------------------------------------------------------------------

def scaled(v: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(v * SCALE), -WIDEST, WIDEST).astype(np.int64) + SHIFT


def limbs(values: np.ndarray) -> list[bytes]:
    """Exact integers as longs of 40 bits, the last one signed."""
    if values.dtype != object:
        low = values & ((1 << BITS) - 1)
        return [low.tobytes(), (values >> BITS).tobytes(), np.zeros_like(values).tobytes()]
    out = [[(int(x) >> BITS * i) & ((1 << BITS) - 1) for x in values] for i in range(LIMBS - 1)]
    out.append([int(x) >> BITS * (LIMBS - 1) for x in values])
    return [np.array(x, np.int64).tobytes() for x in out]


def whole(parts: list[bytes]) -> list[int]:
    arrays = [np.frombuffer(p, np.int64).tolist() for p in parts]
    return [sum(x << BITS * i for i, x in enumerate(t)) for t in zip(*arrays, strict=True)]


def gram(z: np.ndarray) -> np.ndarray:
    """z'z of integers, exactly."""
    peak = int(np.abs(z).max(initial=0))
    if peak * peak * len(z) < 2**53:
        f = z.astype(float)
        return (f.T @ f).astype(np.int64)
    if peak * peak * len(z) < 2**62:
        return z.T @ z
    o = z.astype(object)
    return o.T @ o


def _plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a + b, in Python integers from where longs could run over."""
    if a.dtype != object and b.dtype != object and max(int(np.abs(x).max(initial=0)) for x in (a, b)) < 2**61:
        return a + b
    return a.astype(object) + b.astype(object)


NAMES = [f"p{i}" for i in range(LIMBS)]
SUMS = ", ".join(["dim int", "row int", "salt int", *(f"{p} binary" for p in NAMES)])


def _summed(rows: DataFrame, run) -> DataFrame:
    """(dim, row, limbs) of what every task has summed, added up in two steps."""
    def per_task(batches):
        totals: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims):
                v = matrix(b.column("vec").filter(pa.array(dims == d)))
                for lo in range(0, len(v), ROWS):
                    for row, s in run(int(d), scaled(v[lo:lo + ROWS])):
                        key = int(d), row
                        totals[key] = _plus(totals[key], s) if key in totals else s
        out = [(d, r, 0, *limbs(s)) for (d, r), s in totals.items()]
        cols = list(zip(*out, strict=True)) if out else [[]] * (3 + LIMBS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32() if i < 3 else pa.binary()) for i, c in enumerate(cols)],
            ["dim", "row", "salt", *NAMES])

    def add(t: pa.Table) -> pa.Table:
        first = [t.column(c).slice(0, 1) for c in ("dim", "row", "salt")]
        total = [sum(np.frombuffer(x, np.int64) for x in t.column(p).to_pylist()).tobytes() for p in NAMES]
        return pa.Table.from_arrays([*first, *(pa.array([x], pa.binary()) for x in total)],
                                    ["dim", "row", "salt", *NAMES])

    parts = map_arrow(rows.select("dim", "vec"), per_task, SUMS)
    parts = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    parts = parts.groupBy("dim", "row", "salt").applyInArrow(add, SUMS)
    return parts.groupBy("dim", "row").applyInArrow(add, SUMS)


# ---- the operator ----------------------------------------------------------------------------------

FIT = "dim int, total double, values array<double>, vectors array<double>"


def fit(rows: DataFrame, components: int) -> dict[int, dict]:
    """Per vector length: n, sums S, eigenvalues, vectors and trace; what the driver holds is components x length."""
    spark = rows.sparkSession

    def sums(d: int, x: np.ndarray):
        yield 0, np.concatenate([np.array([len(x)]), x.sum(axis=0)])

    means = {}
    for r in _summed(rows, sums).collect():
        n, *s = whole([r[p] for p in NAMES])
        means[r["dim"]] = n, s
    sent = spark.sparkContext.broadcast(means)

    def products(d: int, x: np.ndarray):
        n, s = sent.value[d]
        g = gram(x - np.array([round_half(a, n) for a in s], np.int64))
        yield from enumerate(g)

    def solve(t: pa.Table) -> pa.Table:
        d = t.column("dim")[0].as_py()
        n, s = sent.value[d]
        rest = [a - n * round_half(a, n) for a in s]
        v = np.zeros((d, d))
        for r in t.to_pylist():
            i = r["row"]
            v[i] = [(n * p - rest[i] * rest[j]) / n**2 for j, p in enumerate(whole([r[c] for c in NAMES]))]
        values, vectors = leading(v, components)
        return pa.Table.from_arrays([pa.array([d], pa.int32()), pa.array([float(np.trace(v))]),
                                     pa.array([values.tolist()]), pa.array([vectors.ravel().tolist()])],
                                    ["dim", "total", "values", "vectors"])

    found = _summed(rows, products).groupBy("dim").applyInArrow(solve, FIT).collect()
    out = {}
    for r in found:
        n, s = means[r["dim"]]
        out[r["dim"]] = {"n": n, "sums": s, "total": r["total"], "values": np.array(r["values"]),
                         "vectors": np.array(r["vectors"]).reshape(-1, r["dim"])}
    return out


def round_half(a: int, n: int) -> int:
    """The integer nearest to a / n."""
    return (2 * a + n) // (2 * n)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: longs, or Python integers where those could run over."""
    mean = [round_half(a, n) for a in sums]
    z, rest = x - np.array(mean, np.int64), [a - n * m for a, m in zip(sums, mean, strict=True)]
    if n * (int(np.abs(z).max(initial=0)) + 1) < 2**62:
        return z * n - np.array(rest, np.int64)
    return z.astype(object) * n - np.array(rest, object)


def deviations(y: np.ndarray) -> list[int | None]:
    """Sums of squares over the rows of y, exactly; None where a long cannot hold one."""
    peak = max((abs(int(y.max(initial=0))), abs(int(y.min(initial=0)))))
    if peak * peak * max(y.shape[1], 1) < 2**63:
        return (y.astype(np.int64) ** 2).sum(axis=1).tolist()
    return [t if (t := sum(int(a) ** 2 for a in r)) < 2**63 else None for r in y]


def whiten(df: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, dim, n, deviation, whitened, explained, identity_error): every usable vector on the leading
    components of the covariance, each scaled to variance one.

    Entries c become x = floor(1024 c) + 100000. Sums and products are exact integers: products are taken of x
    less the integer nearest to its mean, and the fraction left is corrected exactly, so the result does not
    depend on how rows are dealt out. ``deviation`` is the exact sum of (n x - S)^2, null where no long holds it;
    ``explained`` each eigenvalue over the trace; ``identity_error`` the largest entry of the whitened
    covariance less the identity, measured on the rows returned.

    Rows with a null or empty vector, or with anything null or non-finite in it, take no part; a null id stays,
    repeated rows count each. Vectors of different lengths are fitted apart. A vector shorter than
    ``components`` gives as many components as it has entries. A component without variance is null in
    ``whitened`` (all are where all vectors are equal). An empty table gives no row. Entries beyond 2^42 after
    scaling are held there.
    """
    rows = finite(df, key, vector).withColumn("dim", F.size("vec"))
    spark = df.sparkSession
    models = fit(rows, components)
    sent = spark.sparkContext.broadcast(models)

    def project(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims):
                part = b.filter(pa.array(dims == d))
                m = sent.value[int(d)]
                alive = m["values"] > 8 * d * EPS * m["total"]
                scale = np.sqrt(np.where(alive, m["values"], 1.0))
                share = (np.maximum(m["values"], 0) / m["total"]).tolist() if m["total"] > 0 else [None] * len(alive)
                for lo in range(0, len(part), ROWS):
                    p = part.slice(lo, ROWS)
                    y = centred(scaled(matrix(p.column("vec"))), m["n"], m["sums"])
                    w = (y.astype(float) / m["n"]) @ m["vectors"].T / scale
                    flat = pa.array(w.ravel(), mask=np.tile(~alive, len(p)))
                    offs = pa.array(np.arange(len(p) + 1, dtype=np.int32) * len(alive))
                    yield pa.RecordBatch.from_arrays(
                        [p.column("id"), p.column("dim"), pa.array([m["n"]] * len(p), pa.int64()),
                         pa.array(deviations(y), pa.int64()), pa.ListArray.from_arrays(offs, flat),
                         pa.array([share] * len(p), pa.list_(pa.float64()))],
                        ["vec_id", "dim", "n", "deviation", "whitened", "explained"])

    out = cut_lineage(map_arrow(rows.select("id", "vec", "dim"), project,
                                "vec_id long, dim int, n long, deviation long, whitened array<double>, "
                                "explained array<double>"), "whitened")
    return out.join(_errors(out, components), "dim", "left")


def _errors(out: DataFrame, components: int) -> DataFrame:
    """(dim, identity_error) of the whitened rows; one row a vector length."""
    at = lambda i: F.get("whitened", F.lit(i))
    mean = [F.avg(at(i)).alias(f"m{i}") for i in range(components)]
    both = [F.avg(at(i) * at(j)).alias(f"c{i}_{j}") for i in range(components) for j in range(i + 1)]
    sums = out.groupBy("dim").agg(*mean, *both)
    off = [F.abs(F.col(f"c{i}_{j}") - F.col(f"m{i}") * F.col(f"m{j}") - (1.0 if i == j else 0.0))
           for i in range(components) for j in range(i + 1)]
    return sums.select("dim", F.greatest(*off, F.lit(None).cast("double")).alias("identity_error"))


def per_component(whitened: DataFrame) -> DataFrame:
    """One row for each vector and component, numbered from 1."""
    pairs = F.arrays_zip("whitened", "explained")
    return whitened.select("vec_id", F.posexplode(pairs).alias("at", "p"), "n", "deviation", "identity_error").select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("p.whitened").alias("whitened"),
        F.col("p.explained").alias("explained"), "identity_error")
