"""Toxicity: a factorization machine over hashed terms, trained here on a bounded sample of labels."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.llm.common import carried, map_arrow
from lendreach.llm.utf8 import BREAKS, word_blocks
from lendreach.session import cut_lineage

MAX_PER_CLASS = 3_000       # labelled rows of each class that training sees
MAX_TERMS = 4_096           # terms that get weights
MIN_DOCS = 3                # training documents a term must stand in
MIN_CHI = 17.0              # chi-square under which a term is taken for noise
LEAST_TERMS = 64            # terms kept however small the sample is, the most surprising ones
LEAST_ROWS = 32_000         # rows seen in training, over again where there are few
PREFIXES = (4, 5, 6, 7, 8)  # beginnings of words, in bytes, that are terms too: inflected insults share them


@dataclass(frozen=True)
class Machine:
    """score = sigmoid(bias + sum w_t + sum over pairs of terms <v_t, v_u>) over the distinct terms of a text."""
    terms: np.ndarray       # sorted term hashes
    bias: float
    linear: np.ndarray      # one weight a term
    factors: np.ndarray     # terms x rank


def _row_terms(column: pa.Array):
    """The distinct term hashes of every row, in order."""
    for row, h, offs in word_blocks(column, BREAKS, PREFIXES):
        for i in range(len(offs) - 1):
            terms = np.unique(h[:, offs[i]:offs[i + 1]])
            yield row + i, terms[terms > 0]


def term_lists(batches):
    """(toxic, terms): the distinct terms of every row."""
    for b in batches:
        terms = [None] * len(b)
        for i, t in _row_terms(b.column("text")):
            terms[i] = t.tobytes()
        yield pa.RecordBatch.from_arrays(
            [b.column("toxic").cast(pa.int32()), pa.array(terms, pa.binary())], ["toxic", "terms"])


def term_counts(batches):
    """(term, hit, miss): how many rows of each class have a term, summed over a batch."""
    for b in batches:
        rows = [np.frombuffer(t, np.uint64) for t in b.column("terms").to_pylist()]
        toxic = np.repeat(b.column("toxic").to_numpy(), [len(r) for r in rows])
        terms, inv = np.unique(np.concatenate([*rows, np.zeros(0, np.uint64)]), return_inverse=True)
        hit = np.bincount(inv, toxic, len(terms)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms.view(np.int64)), pa.array(hit), pa.array(np.bincount(inv, minlength=len(terms)) - hit)],
            ["term", "hit", "miss"])


def surprise(hit, miss, toxic: float, clean: float, odds: float):
    """Chi-square of a term against the label, as if the clean rows stood in their true ratio to the toxic ones:
    ``odds`` true clean rows for a toxic one. So a term is judged alike whatever was sampled of each class."""
    lift = odds * toxic / max(clean, 1.0)
    miss, total = miss * lift, toxic * (1 + odds)
    share, df = 1 / (1 + odds), hit + miss
    want = df * share
    return (hit - want) * (hit - want) / (want * (1 - share) * (1 - df / (total + 1.0)) + 1e-9)


def _sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of each row's slice; empty rows give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[offs[1:]] - total[offs[:-1]]


def _raw(m: Machine, at: np.ndarray, offs: np.ndarray) -> np.ndarray:
    v = m.factors[at]
    s = _sums(v, offs)
    return m.bias + _sums(m.linear[at], offs) + 0.5 * (s * s - _sums(v * v, offs)).sum(axis=1)


def constant(toxic: int, clean: int, rank: int = 4) -> Machine:
    """What one class, or none, allows: the smoothed share of label 1."""
    return Machine(np.zeros(0, np.uint64), float(np.log((toxic + 0.5) / (clean + 0.5))), np.zeros(0), np.zeros((0, rank)))


def fit(terms: np.ndarray, at_all: np.ndarray, size: np.ndarray, labels: np.ndarray, shift: float = 0.0, rank: int = 4,
        epochs: int = 12, rate: float = 0.1, ridge: float = 3e-4, weight: float = 4.0, seed: int = 7) -> Machine:
    """Adagrad on the logistic loss, rows of label 1 counted ``weight`` times.

    ``terms`` are the sorted hashes that get weights, ``at_all`` the places in it of every row's terms one row
    after the other, ``size`` how many each row has. ``shift`` is added to the bias: the log of the true odds over
    those of the rows, so that a score means the same whatever share of each class was sampled.
    """
    n, k = len(size), len(terms)
    bounds = np.concatenate([[0], np.cumsum(size)])
    rng = np.random.default_rng(seed)
    m = Machine(terms, 0.0, np.zeros(k), rng.normal(0, 0.01, (k, rank)))
    bias, gw, gv, gb = 0.0, np.full(k, 1e-6), np.full((k, rank), 1e-6), 1e-6
    for _ in range(max(epochs, -(-LEAST_ROWS // n))):
        order = rng.permutation(n)
        for lo in range(0, n, 128):
            ids = order[lo:lo + 128]
            length = bounds[ids + 1] - bounds[ids]
            offs = np.concatenate([[0], np.cumsum(length)])
            at = at_all[np.repeat(bounds[ids] - offs[:-1], length) + np.arange(offs[-1])]
            v = m.factors[at]
            s = _sums(v, offs)
            raw = bias + _sums(m.linear[at], offs) + 0.5 * (s * s - _sums(v * v, offs)).sum(axis=1)
            err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[ids]) / len(ids) * np.where(labels[ids] > 0, weight, 1.0)
            each = np.repeat(err, length)
            used, back = np.unique(at, return_inverse=True)
            dw = np.bincount(back, each, len(used)) + ridge * m.linear[used]
            dv = np.stack([np.bincount(back, g, len(used)) for g in
                           (each[:, None] * (np.repeat(s, length, axis=0) - v)).T], axis=1) + ridge * m.factors[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            m.linear[used] -= rate * dw / np.sqrt(gw[used])
            m.factors[used] -= 0.2 * rate * dv / np.sqrt(gv[used])
            gb += err.sum() ** 2
            bias -= rate * err.sum() / np.sqrt(gb)
    return Machine(m.terms, float(bias) + shift, m.linear, m.factors)


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> Machine:
    """Fit on labelled documents for which ``usable`` (over ``doc_id``) holds.

    At most ``MAX_PER_CLASS`` rows of each class are used: those with the least hash of doc_id. Null labels
    and null ids are left out; of several labels of a document the largest counts, and a document whose rows
    repeat is seen once a row. Terms are counted over the sample by Spark; the driver gets at most ``MAX_TERMS``
    of them and, of every row, which of those it has. The true odds of the classes are counted over all usable
    labels and correct both the choice of terms and the bias for what was sampled.
    """
    spark = docs.sparkSession
    named = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
             .filter(usable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    true = {r["toxic"]: r["count"] for r in named.groupBy("toxic").count().collect()}
    first = [named.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_PER_CLASS)
             for c in (0, 1)]
    sample = first[0].unionAll(first[1])
    # at most 2 * MAX_PER_CLASS rows of 12 bytes: a proven bound
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", "text")
    rows = cut_lineage(map_arrow(texts, term_lists, "toxic int, terms binary"), "terms")
    have = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = have.get(1, 0), have.get(0, 0)
    if not toxic or not clean:
        return constant(true.get(1, 0), true.get(0, 0))
    odds = true[0] / true[1]
    counts = (map_arrow(rows, term_counts, "term long, hit long, miss long").groupBy("term")
              .agg(F.sum("hit").alias("hit"), F.sum("miss").alias("miss")).filter(F.col("hit") + F.col("miss") >= MIN_DOCS)
              .withColumn("chi", surprise(F.col("hit"), F.col("miss"), toxic, clean, odds)))
    best = counts.orderBy(F.desc("chi"), "term").limit(MAX_TERMS).select("term", "chi").collect()
    best = [r["term"] for i, r in enumerate(best) if r["chi"] >= MIN_CHI or i < LEAST_TERMS]
    terms = np.sort(np.array(best, np.int64).view(np.uint64))
    sent = spark.sparkContext.broadcast(terms)          # at most MAX_TERMS numbers

    def known(batches):
        for b in batches:
            out = []
            for t in b.column("terms").to_pylist():
                t = np.frombuffer(t, np.uint64)
                at = np.minimum(np.searchsorted(sent.value, t), max(len(sent.value) - 1, 0))
                out.append(at[sent.value[at] == t].astype(np.int32).tobytes() if len(sent.value) else b"")
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(out, pa.binary())], ["toxic", "at"])

    found = map_arrow(rows, known, "toxic int, at binary").toArrow()
    places = [np.frombuffer(x, np.int32) for x in found.column("at").to_pylist()]
    # an order of its own, whatever the partitions were
    order = sorted(range(len(places)), key=lambda i: (found.column("toxic")[i].as_py(), places[i].tobytes()))
    labels_ = np.array(found.column("toxic").to_pylist(), float)[order]
    return fit(terms, np.concatenate([places[i] for i in order]).astype(np.int64), np.array([len(places[i]) for i in order]),
               labels_, shift=float(np.log(true[1] / true[0]) - np.log(toxic / clean)))


def score(docs: DataFrame, machine: Machine, keep: tuple[str, ...] = ("doc_id",),
          text: str = "text") -> DataFrame:
    """Columns ``keep`` with ``score`` (0 to 1) of the whole text; a null or empty text scores the bias alone."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)    # at most MAX_TERMS rows
    kept, body = carried(docs, keep, text)

    def run(batches):
        m, mask = sent.value, np.uint64((1 << 20) - 1)
        maybe = np.zeros(1 << 20, bool)     # most terms are none of the machine's: one look-up tells
        maybe[m.terms & mask] = True
        for b in batches:
            out = np.zeros(len(b))
            for row, h, offs in word_blocks(b.column(body), BREAKS, PREFIXES):
                n, pairs = len(offs) - 1, []
                doc = np.repeat(np.arange(n), np.diff(offs))
                for kind in h if len(m.terms) else ():
                    seen = np.flatnonzero(maybe[kind & mask])
                    at = np.minimum(np.searchsorted(m.terms, kind[seen]), len(m.terms) - 1)
                    known = m.terms[at] == kind[seen]
                    pairs.append(doc[seen[known]] * np.int64(len(m.terms)) + at[known])
                doc, at = np.divmod(np.unique(np.concatenate([*pairs, np.zeros(0, np.int64)])),
                                    max(1, len(m.terms)))
                raw = _raw(m, at, np.searchsorted(doc, np.arange(n + 1)))
                out[row:row + n] = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(out)], [*keep, "score"])

    schema = kept.select(*keep).schema.add("score", "double")
    return map_arrow(kept, run, schema)


def toxic_scores(docs: DataFrame, labels: DataFrame, usable: Column, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Train on the usable labels, score every document; repeated rows score alike. An empty table gives an empty
    table."""
    return score(docs, train(docs, labels, usable), keep)
