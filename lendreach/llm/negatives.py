"""Hard negatives by exact integer scores: many candidates' components packed into the fields of one wide integer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendreach.llm.common import ship
from lendreach.llm.vectors import finite, matrix
from lendreach.session import cut_lineage

ROWS = 8_192            # candidates, and anchors, of one group
ANCHORS = 256           # anchors scored at once: bounds the scores a task holds
WIDEST = 2**31 - 1      # scaled components beyond this are held there
PACK = 1_024            # candidates of one wide Python integer
DOUBLE_BITS = 53        # integers up to 2^53 are exact in a double


class Packed:
    """Candidates (rows of ``x``, integers) ready to be multiplied by anchors, several with one product.

    Components are biased to be at least 0, so that fields never borrow from each other. A field is as wide as
    the largest sum of products needs. Where two or more fields fit the 53 bits of a double, one product of
    matrices of such doubles gives several exact scores at a time; wider fields go into Python integers of
    ``PACK`` fields each.
    """

    def __init__(self, x: np.ndarray):
        self.bias = int(x.min(initial=0))
        self.x = x - self.bias
        self.high = int(self.x.max(initial=0))
        self.sums = self.x.sum(axis=1)
        self.packs: dict[int, object] = {}

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Anchors x candidates, exact: longs, or Python integers where those could run over."""
        bias, d = int(anchors.min(initial=0)), anchors.shape[1]
        a = anchors - bias
        most = d * self.high * int(a.max(initial=0))
        bits = max(most.bit_length(), 1)
        raw = self._doubles(a, bits) if 2 * bits <= DOUBLE_BITS else self._wide(a, -(-bits // 8))
        small = max(abs(bias), abs(self.bias)) * max(abs(bias), abs(self.bias), self.high, WIDEST) * d < 2**61
        kind = np.int64 if raw.dtype != object and small else object
        return (raw.astype(kind) + bias * self.sums.astype(kind)[None, :]
                + self.bias * a.sum(axis=1).astype(kind)[:, None] + d * bias * self.bias)

    def _doubles(self, a: np.ndarray, bits: int) -> np.ndarray:
        """``fields`` scores from every product."""
        fields = DOUBLE_BITS // bits
        if bits not in self.packs:
            n = -(-len(self.x) // fields)
            padded = np.zeros((n * fields, self.x.shape[1]), np.int64)
            padded[:len(self.x)] = self.x
            parts = padded.reshape(n, fields, -1)
            self.packs[bits] = sum(parts[:, f] << bits * f for f in range(fields)).astype(float)
        product = (a.astype(float) @ self.packs[bits].T).astype(np.int64)
        out = np.stack([product >> bits * f & (1 << bits) - 1 for f in range(fields)], axis=2)
        return out.reshape(len(a), -1)[:, :len(self.x)]

    def _wide(self, a: np.ndarray, width: int) -> np.ndarray:
        """Fields of ``width`` bytes; a component of ``PACK`` candidates is one integer."""
        if -width not in self.packs:
            self.packs[-width] = [[self._integer(self.x[lo:lo + PACK, d], width) for d in range(a.shape[1])]
                                  for lo in range(0, len(self.x), PACK)]
        out = np.zeros((len(a), len(self.x)), object)
        for i, row in enumerate(a.tolist()):
            for p, columns in enumerate(self.packs[-width]):
                n = min(PACK, len(self.x) - p * PACK)
                total = sum(c * v for c, v in zip(columns, row, strict=True)).to_bytes(n * width, "little")
                out[i, p * PACK:p * PACK + n] = [int.from_bytes(total[k * width:(k + 1) * width], "little")
                                                 for k in range(n)]
        return out

    @staticmethod
    def _integer(column: np.ndarray, width: int) -> int:
        return int.from_bytes(b"".join(int(v).to_bytes(width, "little") for v in column), "little")


def held(s: np.ndarray) -> np.ndarray:
    """Scores as longs; what no long holds stands at its ends."""
    return s if s.dtype != object else np.clip(s, -2**63, 2**63 - 1).astype(np.int64)


def best(score: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Those ``k`` of the places ``at`` with the largest scores, ties to the lesser id."""
    if len(at) > k:
        at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]
    return at[np.lexsort((ids[at], -score[at].astype(object) if score.dtype == object else -score[at]))[:k]]


def numbers(rows: DataFrame, key: str, label: str, vector: str, scale: int) -> DataFrame:
    """(id, label, dim, vec int) of the rows that take part, one an id: the least in (label, vector)."""
    x = finite(rows, key, vector, F.col(label).cast("long").alias("label"))
    whole = F.transform("vec", lambda c: F.least(F.greatest(F.floor(c * F.lit(float(scale))), F.lit(-WIDEST)),
                                                 F.lit(WIDEST)).cast("int"))
    one = x.filter("id is not null and label is not null").select("id", F.struct("label", whole.alias("vec")).alias("r"))
    one = one.groupBy("id").agg(F.min("r").alias("r"))
    return one.select("id", "r.label", F.size("r.vec").alias("dim"), "r.vec")


def _dealt(rows: DataFrame, into: str, count: str, each: str, copies: str) -> DataFrame:
    """Rows in one of ``count`` parts by id, once for each of ``copies`` parts of the other side."""
    out = (rows.withColumn(into, F.pmod(F.xxhash64("id"), F.col(count)).cast("int"))
           .withColumn(each, F.explode(F.sequence(F.lit(0), F.col(copies) - 1))).drop(count, copies))
    return out.toDF(*out.columns)       # columns of its own: both sides come from one table


def mine(df: DataFrame, chosen: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows ``chosen`` (over
    ``id``): an anchor's positives are its ``positives`` best others of the same label, and each of them takes the
    ``negatives`` best rows of other labels that score between ``low`` and ``high`` hundredths of it.

    Scores are exact inner products of floor(scale * x); ties go to the lesser id. Every anchor meets every row:
    both sides are dealt into groups of about ``ROWS`` by id, so no label, vector or anchor gathers in one task.
    Positives meet only within the label.

    Rows with a null id, label or vector, or with anything null or non-finite in it, take no part; neither do
    empty vectors. Vectors of different lengths never meet. A repeated id counts once, with its least (label,
    vector). A pair whose window holds nothing (always so where the positive scores below 0) gives no row; an
    empty table gives none. Scaled components are held within 31 bits, scores within a long.
    """
    rows = cut_lineage(numbers(df, key, label, vector, scale), "negatives")
    ship(df.sparkSession)
    ask = rows.filter(chosen)
    parts = lambda c: F.greatest(F.ceil(F.col(c) / ROWS).cast("int"), F.lit(1))

    # positives: groups of one label
    sizes = (rows.groupBy("dim", "label").agg(F.count("*").alias("n"), F.count(F.when(chosen, 1)).alias("a"))
             .filter("a > 0").select("dim", "label", parts("n").alias("blocks"), parts("a").alias("pieces")))
    left = _dealt(rows.join(sizes, ["dim", "label"]), "block", "blocks", "piece", "pieces")
    right = _dealt(ask.join(sizes, ["dim", "label"]), "piece", "pieces", "block", "blocks")

    def same(c: pa.Table, q: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        for ids, score, part in _scored(c, q):
            for i, name in enumerate(part.column("id").to_numpy()):
                top = best(score[i], ids, np.flatnonzero(ids != name), positives)
                out[0] += [name] * len(top)
                out[1] += ids[top].tolist()
                out[2] += score[i][top].tolist()
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in out], ["anchor_id", "positive_id", "positive_score"])

    by = ["dim", "label", "block", "piece"]
    found = left.groupBy(by).cogroup(right.groupBy(by)).applyInArrow(
        same, "anchor_id long, positive_id long, positive_score long")
    order = W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    wanted = found.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= positives).drop("at")
    # windows with room only; at most ``positives`` of an anchor
    wanted = (wanted.filter(F.col("positive_score") >= 0).groupBy("anchor_id")
              .agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("pairs")))

    # negatives: all labels mixed
    ask = cut_lineage(ask.join(wanted.withColumnRenamed("anchor_id", "id"), "id"), "anchors")
    sizes = (rows.groupBy("dim").agg(F.count("*").alias("n")).join(
        ask.groupBy("dim").agg(F.count("*").alias("a")), "dim")
        .select("dim", parts("n").alias("blocks"), parts("a").alias("pieces")))
    left = _dealt(rows.join(sizes, "dim"), "block", "blocks", "piece", "pieces")
    right = _dealt(ask.join(sizes, "dim"), "piece", "pieces", "block", "blocks")

    def other(c: pa.Table, q: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        labels = c.column("label").to_numpy() if len(c) else np.zeros(0, np.int64)
        for ids, score, part in _scored(c, q):
            names, kinds = part.column("id").to_pylist(), part.column("label").to_pylist()
            for i, pairs in enumerate(part.column("pairs").to_pylist()):
                s = score[i]
                ends = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in pairs]
                fit = np.flatnonzero((labels != kinds[i]) & (s >= min(a for a, _ in ends))
                                     & (s <= max(z for _, z in ends)))
                for p, (a, z) in zip(pairs, ends, strict=True):
                    top = best(s, ids, fit[(s[fit] >= a) & (s[fit] <= z)], negatives)
                    out[0] += [names[i]] * len(top)
                    out[1] += [p["positive_id"]] * len(top)
                    out[2] += ids[top].tolist()
                    out[3] += [p["positive_score"]] * len(top)
                    out[4] += s[top].tolist()
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in out], names_out)

    names_out = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
    by = ["dim", "block", "piece"]
    hits = left.groupBy(by).cogroup(right.groupBy(by)).applyInArrow(other, ", ".join(f"{n} long" for n in names_out))
    order = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _scored(c: pa.Table, q: pa.Table):
    """(candidate ids, anchors x candidates, the anchors) for a few anchors at a time."""
    if not len(c) or not len(q):
        return
    ids, packed = c.column("id").to_numpy(), Packed(matrix(c.column("vec")).astype(np.int64))
    for lo in range(0, len(q), ANCHORS):
        part = q.slice(lo, ANCHORS)
        yield ids, held(packed.scores(matrix(part.column("vec")).astype(np.int64))), part
