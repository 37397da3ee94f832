"""Mixing sources to target weights: Pfair windows per block, interleaved by earliest deadline."""

from __future__ import annotations

import heapq
import itertools
import math
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendreach.llm.common import map_arrow, numbered

BATCH = 16_384          # blocks dealt out at once


def integer_weights(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole weights of at least 1 that sum to ``period``, by largest remainder; ties go to the lesser name."""
    period = max(period, len(weights))
    total, spare = sum(weights.values()), period - len(weights)
    exact = {s: w / total * spare for s, w in weights.items()}
    out = {s: 1 + math.floor(x) for s, x in exact.items()}
    left = sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], s))
    for s in left[:period - sum(out.values())]:
        out[s] += 1
    return out


def whole_shares(targets: dict[str, object]) -> dict[str, int]:
    """Integers in exactly the ratio of the targets; a float counts as the decimal number it prints as."""
    exact = {s: Fraction(str(w)) for s, w in targets.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    return {s: w.numerator * (scale // w.denominator) for s, w in exact.items()}


def edf(weights: dict[str, int]):
    """Endless (slot, source, i, release, deadline): with share w of all weights, block i of a source is released
    at floor(i/w), is due by ceil((i+1)/w), and each slot goes to the released block that is due first (ties:
    lesser name)."""
    total = sum(weights.values())
    waiting: list[tuple[int, str, int]] = []
    ready = [(-(-total // w), s, 0, 0) for s, w in weights.items()]
    heapq.heapify(ready)
    for slot in itertools.count():
        while waiting and waiting[0][0] <= slot:
            release, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // weights[s]), s, i, release))
        due, s, i, release = heapq.heappop(ready)
        yield slot, s, i, release, due
        heapq.heappush(waiting, ((i + 1) * total // weights[s], s, i + 1))


def edf_period(weights: dict[str, int]) -> dict[str, list[int]]:
    """Slot of every block of one period, that is of as many slots as the weights sum to."""
    slots: dict[str, list[int]] = {s: [] for s in weights}
    for slot, s, *_ in itertools.islice(edf(weights), sum(weights.values())):
        slots[s].append(slot)
    return slots


def schedule(blocks: dict[str, int], weights: dict[str, object], period: int | None = None):
    """Every block's (source, block, phase, release, deadline, slot), in the order of slots. A phase ends when a
    source has no block left; the others go on with their weights scaled up, so nothing is dropped and every
    phase keeps its targets to less than one block. Holds one entry a source, whatever the number of blocks."""
    left = {s: n for s, n in blocks.items() if n > 0}
    exact = whole_shares({s: weights[s] for s in left}) if left and not period else {}
    done, base, phase = dict.fromkeys(left, 0), 0, 0
    while left:
        w = ({s: exact[s] for s in left} if not period else
             integer_weights({s: float(weights[s]) for s in left}, 1 if len(left) == 1 else period))
        for slot, s, i, release, due in edf(w):
            yield s, done[s], phase, base + release, base + due, base + slot
            done[s] += 1
            left[s] -= 1
            if not left[s]:
                del left[s]
                base, phase = base + slot + 1, phase + 1
                break


def mix_sources(df: DataFrame, source: str, key: str, weights: dict[str, float] | None = None,
                block_rows: int = 8, period: int | None = None) -> DataFrame:
    """Every row with its place in the mixture: block, phase, release, deadline, slot and in_block.

    Reading rows by (slot, in_block) gives the mixture. ``weights`` are target shares by source; None takes
    the square root of each source's rows, and a source that is not named takes the least named weight.
    Weights must be over 0; they are dealt exactly. Only a caller who names a ``period`` has them rounded to
    whole numbers of at least 1 that sum to it. A null source is a source of its own. Rows of a source are cut
    into blocks of ``block_rows`` in the order of :func:`numbered`; only its last block may be short. One task
    deals out the blocks from one row a source, of any number of sources, and holds no more than those rows.
    An empty table gives an empty table. Repeated keys are rows like any other.
    """
    name = "__source"
    if weights is not None and (not weights or min(weights.values()) <= 0):
        raise ValueError("weights must be over 0")
    df = df.withColumn(name, F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null")))
    named = None if weights is None else {"null" if s is None else f"={s}": w for s, w in weights.items()}

    def deal(batches):
        counts = {}
        for b in batches:
            counts.update(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        if named is None:
            target = {s: math.sqrt(n) for s, n in counts.items()}
        else:
            least = min(named.values())
            target = {s: named.get(s, least) for s in counts}
        placed = schedule({s: -(-n // block_rows) for s, n in counts.items()}, target, period)
        while rows := list(itertools.islice(placed, BATCH)):
            cols = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int32(), *[pa.int64()] * 3),
                                                strict=True)],
                ["__s", "__block", "__phase", "__release", "__deadline", "__slot"])

    counts = df.groupBy(name).count().repartition(1)
    plan = map_arrow(counts, deal, "__s string, __block long, __phase int, __release long, __deadline long, __slot long")
    rows = (numbered(df, F.col(name), F.col(key), "__n")
            .withColumns({"block": F.floor(F.col("__n") / block_rows),
                          "in_block": (F.col("__n") % block_rows).cast("int")}))
    rows = rows.join(plan, (F.col(name) == F.col("__s")) & (F.col("block") == F.col("__block")))
    return (rows.withColumns({c: F.col(f"__{c}") for c in ("phase", "slot", "release", "deadline")})
            .drop(name, "__n", "__s", "__block", "__phase", "__slot", "__release", "__deadline"))
