"""Language identification by cross-parsing: the fewest phrases against suffix automata of labelled text."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendreach.llm.common import carried, map_arrow

SAMPLE_DOCS = 128       # documents of each language that are learned from
SAMPLE_CHARS = 256      # code points taken from each of them
ALPHABET = 40           # most frequent letters, one symbol each; other letters of the sample are two symbols
WINDOW = 2048           # symbols parsed in one lane; a phrase also ends there
LANES = 2048
SHARPNESS = 16.0        # of the score, in bits a symbol
MISS = np.int32(-2**31)


@dataclass(frozen=True)
class Sample:
    """Bounded training text: one string a language, in the order of the names."""
    langs: tuple[str, ...]
    texts: tuple[str, ...]


@dataclass
class Parser:
    """Transition table of all automata, one row a state: next row, or MISS with the row to go on from."""
    langs: tuple[str, ...]
    symbol: np.ndarray      # code point -> symbol
    second: np.ndarray      # code point -> the symbol that follows it, or 0
    local: np.ndarray       # language x symbol -> column of its rows; 0 for what its sample does not hold
    letter: np.ndarray      # code point -> is a letter
    table: np.ndarray       # flat; entries are row starts
    roots: np.ndarray
    bits: np.ndarray        # log2 of each training length: what one phrase costs


def suffix_automaton(symbols: list[int], size: int) -> np.ndarray:
    """Transitions (state x symbol, -1 for none) of the automaton of all substrings; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    out = np.full((len(nxt), size), -1, np.int32)
    for s, edges in enumerate(nxt):
        for c, t in edges.items():
            out[s, c] = t
    return out


def folded(c: str) -> str:
    return c.lower() if len(c.lower()) == 1 else c


def spell(symbol: np.ndarray, second: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Symbols of code points; rarer letters are spelt with two."""
    one, two = symbol[codes], second[codes]
    if not two.any():
        return one
    width = 1 + (two > 0)
    out, at = np.zeros(int(width.sum()), one.dtype), np.cumsum(width) - width
    out[at] = one
    out[at[two > 0] + 1] = two[two > 0]
    return out


def fold_text(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(maxsize=2)
def build(sample: Sample) -> Parser:
    """Automata of a sample; built once in each Python worker.

    Every letter of the sample keeps its identity, whatever the number of scripts: the ``ALPHABET`` commonest have
    a symbol each, the others a pair out of two further sets of symbols. Each automaton has columns only for the
    symbols of its own sample, as all others end a phrase alike.
    """
    seen = Counter("".join(sample.texts))
    common: Counter = Counter()
    for c, n in seen.items():
        if c.isalpha():
            common[folded(c)] += n
    letters = sorted(common, key=lambda c: (-common[c], c))
    kept, rare = letters[:ALPHABET], letters[ALPHABET:]
    # 0: any letter that the sample does not hold, 1: digits, 2: everything else
    half = int(np.ceil(np.sqrt(len(rare))))
    k = len(kept) + 3
    codes_of = {c: (i, 0) for i, c in enumerate(kept, 3)}
    codes_of |= {c: (k + i // half, k + half + i % half) for i, c in enumerate(rare)}
    letter = np.zeros(0x110000, bool)
    letter[:] = [chr(i).isalpha() for i in range(0x110000)]
    symbol = np.where(letter, 0, 2).astype(np.uint16)
    second = np.zeros(0x110000, np.uint16)
    symbol[48:58] = 1
    for c, (first, then) in codes_of.items():
        for form in {c, c.upper()}:
            if len(form) == 1:
                symbol[ord(form)], second[ord(form)] = first, then
    parts, roots, base = [], [], 0
    local = np.zeros((len(sample.texts), k + 2 * half), np.int32)
    for i, text in enumerate(sample.texts):
        syms = spell(symbol, second, fold_text(text))
        own = np.unique(syms)
        local[i, own] = np.arange(1, len(own) + 1)
        wide = len(own) + 1
        t = suffix_automaton(local[i, syms].tolist(), wide)
        rows = t * wide + base
        again = np.where(t[0] < 0, np.int32(base), rows[0])
        parts.append(np.where(t < 0, again[None, :] | MISS, rows).astype(np.int32).ravel())
        roots.append(base)
        base += t.size
    table = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    bits = np.log2(np.array([max(2, len(t)) for t in sample.texts], float))
    return Parser(sample.langs, symbol, second, local, letter, table, np.array(roots, np.int32), bits)


def phrases(p: Parser, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases (text x language), symbols and has-a-letter of each text; whole texts, in lanes of ``WINDOW``."""
    count = np.zeros((len(texts), len(p.langs)), np.int64)
    size, lettered = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
    lanes: list[tuple[np.ndarray, int]] = []

    def flush() -> None:
        lanes.sort(key=lambda x: -len(x[0]))
        lengths = np.array([len(x) for x, _ in lanes])
        grid = np.zeros((int(lengths[0]), len(lanes)), np.int32)
        for i, (x, _) in enumerate(lanes):
            grid[:len(x), i] = x
        state = np.repeat(p.roots[:, None], len(lanes), axis=1)
        ends = np.zeros(state.shape, np.int32)
        live = np.searchsorted(-lengths, -np.arange(1, len(grid) + 1), "right")
        for t, n in enumerate(live):
            to = p.table[state[:, :n] + p.local[:, grid[t, :n]]]
            ends[:, :n] += to < 0
            state[:, :n] = to & np.int32(0x7FFFFFFF)
        np.add.at(count, np.array([d for _, d in lanes]), ends.T + 1)
        lanes.clear()

    for d, text in enumerate(texts):
        codes = fold_text(text)
        size[d], lettered[d] = len(codes), bool(p.letter[codes].any())
        if lettered[d] and len(p.langs):
            syms = spell(p.symbol, p.second, codes)
            for lo in range(0, len(syms), WINDOW):
                lanes.append((syms[lo:lo + WINDOW], d))
                if len(lanes) == LANES:
                    flush()
    if lanes:
        flush()
    return count, size, lettered


def learn(docs: DataFrame, usable: Column) -> Sample:
    """The bounded sample: of every language, ``SAMPLE_CHARS`` code points from each of the ``SAMPLE_DOCS``
    usable documents with the least hash of doc_id, starting at a place that the hash chooses."""
    # the last place from which a full sample can start, so that long documents give more than their beginnings
    start = F.pmod(F.xxhash64("doc_id", F.lit(1)),
                   F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1).cast("int") + 1
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = (docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
            .select("lang", "doc_id", F.expr("text").substr(start, F.lit(SAMPLE_CHARS)).alias("piece"))
            .withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= SAMPLE_DOCS)
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("__r", "piece"))).alias("pieces"))
            .select("lang", F.array_join("pieces.piece", "\n").alias("text")).orderBy("lang").collect())
    rows = [r for r in rows if any(c.isalpha() for c in r["text"])]
    return Sample(tuple(r["lang"] for r in rows), tuple(r["text"] for r in rows))


def identify(docs: DataFrame, sample: Sample, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with lang_pred, score, phrases and symbols of every whole text.

    The cost of a language is its phrases times log2 of its training length, a symbol. The least cost wins,
    ties go to the lesser name. ``und`` with score 0 is given to a null text, a text without a letter, and to
    all if nothing could be learned. Repeated rows are scored alike. A phrase also ends every ``WINDOW`` symbols,
    in all languages at the same places.
    """
    sent = docs.sparkSession.sparkContext.broadcast(sample)     # at most SAMPLE_DOCS * SAMPLE_CHARS a language
    kept, body = carried(docs, keep, "text")

    def run(batches):
        p = build(sent.value)
        for whole in batches:
            for lo in range(0, len(whole), 1000):
                b = whole.slice(lo, 1000)
                count, size, lettered = phrases(p, [t or "" for t in b.column(body).to_pylist()])
                langs = [None] * len(b)
                score, best = np.zeros(len(b)), np.zeros(len(b), np.int64)
                if len(p.langs):
                    cost = count * p.bits / np.maximum(size, 1)[:, None]
                    at = cost.argmin(axis=1)
                    best = count[np.arange(len(b)), at]
                    odds = np.exp2(-SHARPNESS * (cost - cost.min(axis=1, keepdims=True)))
                    score = 1 / odds.sum(axis=1)
                    langs = [p.langs[i] for i in at]
                ok = lettered & bool(len(p.langs))
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in keep],
                     pa.array([x if k else "und" for x, k in zip(langs, ok, strict=True)], pa.string()),
                     pa.array(np.where(ok, score, 0.0)), pa.array(np.where(ok, best, 0)), pa.array(size)],
                    [*keep, "lang_pred", "score", "phrases", "symbols"])

    schema = (kept.select(*keep).schema.add("lang_pred", "string").add("score", "double")
              .add("phrases", "long").add("symbols", "long"))
    return map_arrow(kept, run, schema)
