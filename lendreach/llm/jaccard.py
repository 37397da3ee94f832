"""Exact n-gram Jaccard self-join by set relations: positional index lists read with block skipping, and answers
of a set derived from those of a similar set: sets of a family are kept as their differences from one of them, and
how far two of them are apart follows from the differences alone."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendreach.llm.common import map_arrow
from lendreach.llm.components import components
from lendreach.llm.utf8 import mix, shingles, word_blocks
from lendreach.session import cut_lineage

CELLS = 1 << 17         # counters that order shingles from rare to frequent
SKETCH_BLOCKS = 32
SIG_WORDS = 8           # 64-bit words of a set's parity bitmap
BLOCK = 2_048           # places of an index list that stay together
SMALL_RUN = 24
LONG = 512              # sets of so many elements also have a bitmap of about two bits an element
PIECE = 512             # sets of a family that are compared with its pivot in one go
FAMILY = 1_024          # sets of a family whose differences meet in one group
HELD = 16 << 20         # bytes of differences that meet in one group


@dataclass(frozen=True)
class Rule:
    """Sets of shingles of ``words`` words link when num / den <= intersection / union."""
    words: int = 3
    num: int = 90
    den: int = 100

    def prefix(self, n: int) -> int:
        """How many of its rarest shingles a set of n lists: any linked pair shares one of them."""
        return n - -(-self.num * n // self.den) + 1

    def least(self, total):
        """The least intersection of linked sets whose sizes sum to ``total``."""
        return -(-total * self.num // (self.num + self.den))


def fingerprint(h: np.ndarray) -> int:
    """64-bit name of a set: equal sets have equal names."""
    with np.errstate(over="ignore"):
        total = mix(h + np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64) + np.uint64(len(h))
        return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def parity(h: np.ndarray, size: int = 64 * SIG_WORDS) -> bytes:
    """Bitmap of how often (odd or even) each of its ``size`` bits is hit: two sets differ in at least as many
    elements as their bitmaps differ in bits."""
    bits = np.bincount((h & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def wide(h: np.ndarray) -> bytes | None:
    """The larger bitmap of a long set; its size is a power of two, so it folds to any smaller one."""
    return parity(h, 1 << int(2 * len(h) - 1).bit_length()) if len(h) >= LONG else None


def folded(bitmaps: np.ndarray, words: int) -> np.ndarray:
    """Rows of bitmaps brought to ``words`` 64-bit words: the halves of a bitmap add up by exclusive or."""
    while bitmaps.shape[1] > words:
        half = bitmaps.shape[1] // 2
        bitmaps = bitmaps[:, :half] ^ bitmaps[:, half:]
    return bitmaps


def row_sets(column: pa.Array, words: int):
    """(row, shingle hashes) of every text."""
    for row, h, offs in word_blocks(column):
        for i in range(len(offs) - 1):
            yield row + i, shingles(h[offs[i]:offs[i + 1]], words)


def _cell(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(17)) & np.uint64(CELLS - 1)).astype(np.int64)


# ---- what the texts give ---------------------------------------------------------------------------

def profiles(docs: DataFrame, rule: Rule) -> DataFrame:
    """One pass over the texts: n, name and bitmap of every document, and the counters of each task."""
    def run(batches):
        counts = np.zeros(CELLS, np.int64)
        for b in batches:
            n, fp = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            sig, large = [None] * len(b), [None] * len(b)
            held: list[np.ndarray] = []
            for i, h in row_sets(b.column("text"), rule.words):
                n[i] = len(h)
                if len(h):
                    fp[i], sig[i], large[i] = fingerprint(h), parity(h), wide(h)
                    held.append(h)
                if len(held) == 256:
                    counts += np.bincount(_cell(np.concatenate(held)), minlength=CELLS)
                    held.clear()
            if held:
                counts += np.bincount(_cell(np.concatenate(held)), minlength=CELLS)
            none = pa.nulls(len(b))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(n), pa.array(fp), pa.array(sig, pa.binary()),
                 pa.array(large, pa.binary()), none.cast(pa.int32()), none.cast(pa.binary())], names)
        step = CELLS // SKETCH_BLOCKS
        parts = [counts[i * step:(i + 1) * step] for i in range(SKETCH_BLOCKS)]
        some = [i for i, c in enumerate(parts) if c.any()]
        none = pa.nulls(len(some))
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()),
             none.cast(pa.binary()), pa.array(some, pa.int32()), pa.array([parts[i].tobytes() for i in some], pa.binary())], names)

    names = ["doc_id", "n", "fp", "sig", "wide", "block", "counts"]
    rows = map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                     "doc_id long, n long, fp long, sig binary, wide binary, block int, counts binary")
    return cut_lineage(rows, "profiles")


def frequencies(profile: DataFrame) -> np.ndarray:
    """The counters of all documents: ``CELLS`` numbers, however many documents there are."""
    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.int64) for c in t.column("counts").to_pylist())
        return pa.table({"block": t.column("block").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    out, step = np.zeros(CELLS, np.int64), CELLS // SKETCH_BLOCKS
    sums = (profile.filter("block is not null").select("block", "counts")
            .groupBy("block").applyInArrow(add, "block int, counts binary"))
    for r in sums.collect():
        out[r["block"] * step:(r["block"] + 1) * step] = np.frombuffer(r["counts"], np.int64)
    return out


def postings(docs: DataFrame, rule: Rule, counts: np.ndarray) -> DataFrame:
    """(token, fp, n, pos) of the rarest shingles of every set; a task lists equal sets once."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(counts.astype(np.int64))     # CELLS numbers

    def run(batches):
        weight, seen = sent.value, set()
        for b in batches:
            out: list[list] = [[], [], [], []]
            for _, h in row_sets(b.column("text"), rule.words):
                if not len(h) or (fp := fingerprint(h)) in seen:
                    continue
                seen.add(fp)
                p = rule.prefix(len(h))
                freq = weight[_cell(h)]
                if p < len(h):      # only what can be in the prefix is sorted
                    cut = np.partition(freq, p - 1)[p - 1]
                    keep = freq <= cut
                    h, n, freq = h[keep], len(h), freq[keep]
                else:
                    n = len(h)
                first = h[np.lexsort((h, freq))[:p]]
                for c, v in zip(out, (first.view(np.int64), np.full(len(first), fp), np.full(len(first), n),
                                      np.arange(len(first))), strict=True):
                    c.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out],
                                                 ["token", "fp", "n", "pos"])

    return map_arrow(docs.select("text"), run, "token long, fp long, n long, pos long")


# ---- index lists -----------------------------------------------------------------------------------

def index_lists(rows: DataFrame) -> DataFrame:
    """Postings of tokens that two sets share, with the block of each place: lists stand by (n, fp)."""
    def run(batches):
        last = place = None             # of the list being read; ``first`` waits for a second set
        first = None
        for b in batches:
            tok, fp = b.column("token").to_numpy(), b.column("fp").to_numpy()
            if not len(tok):
                continue
            new = np.ones(len(tok), bool)
            new[1:] = tok[1:] != tok[:-1]
            same = np.zeros(len(tok), bool)         # the same set, listed by another task
            same[1:] = ~new[1:] & (fp[1:] == fp[:-1])
            goes_on = last is not None and tok[0] == last[0]
            if goes_on:
                new[0], same[0] = False, fp[0] == last[1]
            keep = ~same
            kept = np.flatnonzero(keep)
            starts = new[kept]
            group = np.cumsum(starts) if len(kept) else np.zeros(0, np.int64)
            # places: counted from the start of each list, which may lie in an earlier batch
            begin = np.maximum.accumulate(np.where(starts, np.arange(len(kept)), -1)) if len(kept) else group
            at = np.where(begin >= 0, np.arange(len(kept)) - begin, np.arange(len(kept)) + (place or 0))
            sizes = np.bincount(group, minlength=int(group[-1]) + 1 if len(group) else 1)
            long_ = sizes[group] > 1
            if goes_on:
                long_ |= group == 0
                if first is not None and len(kept) and group[0] == 0:
                    yield first
                    first = None
            else:
                first = None
            final = int(group[-1]) if len(group) else -1
            if len(kept) and not (goes_on and final == 0):
                first = None
                if sizes[final] == 1:
                    first = _listed(b.take(pa.array(kept[-1:])), at[-1:])
            last = (tok[-1], fp[-1])
            if len(kept):
                place = int(at[-1]) + 1
            if long_.any():
                yield _listed(b.take(pa.array(kept[long_])), at[long_])

    ordered = rows.repartition("token").sortWithinPartitions("token", "n", "fp", "pos")
    return map_arrow(ordered, run, "token long, fp long, n long, pos long, block long")


def _listed(b: pa.RecordBatch, at: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*b.columns, pa.array(at // BLOCK)], ["token", "fp", "n", "pos", "block"])


def block_pairs(lists: DataFrame, rule: Rule) -> DataFrame:
    """Every posting with the pairs of blocks (lo <= hi) of its list in which it is read. Pairs whose sizes
    cannot link are skipped; most lists are one block, which meets only itself."""
    spans = (lists.groupBy("token", "block").agg(F.min("n").alias("a"), F.max("n").alias("z"))
             .join(lists.filter("block > 0").select("token").distinct(), "token"))
    left = spans.select("token", F.col("block").alias("lo"), F.col("z").alias("most"))
    right = spans.select("token", F.col("block").alias("hi"), F.col("a").alias("few"))
    meets = (left.join(right, "token").filter("lo < hi").filter(F.col("few") * rule.num <= F.col("most") * rule.den)
             .select("token", "lo", "hi"))
    own = lists.withColumns({"lo": F.col("block"), "hi": F.col("block")})
    more = meets.withColumn("block", F.explode(F.array("lo", "hi")))
    return own.unionByName(lists.join(more, ["token", "block"]).select(*own.columns))


class Run:
    """Postings of consecutive (token, lo, hi) groups as arrays."""

    def __init__(self, t: pa.RecordBatch):
        self.fp, self.n, self.pos, self.block = (t.column(c).to_numpy() for c in ("fp", "n", "pos", "block"))
        sig = t.column("sig").cast(pa.binary(8 * SIG_WORDS))
        raw = np.frombuffer(sig.buffers()[1], np.uint8)[sig.offset * 64:(sig.offset + len(sig)) * 64]
        self.sig = raw.view(np.uint64).reshape(-1, SIG_WORDS)
        self.lo, self.hi = t.column("lo").to_numpy(), t.column("hi").to_numpy()

    def may_link(self, i: np.ndarray, j: np.ndarray, rule: Rule) -> np.ndarray:
        """No linked pair fails: sizes, what is left of both sets from here on, and the bitmaps allow it."""
        n, m = self.n[i], self.n[j]
        least = rule.least(n + m)
        ok = (self.fp[i] != self.fp[j]) & (np.minimum(n, m) * rule.den >= np.maximum(n, m) * rule.num)
        ok &= np.minimum(n - self.pos[i], m - self.pos[j]) >= least
        ok &= (self.lo[i] == self.hi[i]) | (self.block[i] != self.block[j])
        at = np.flatnonzero(ok)
        if len(at):
            apart = np.bitwise_count(self.sig[i[at]] ^ self.sig[j[at]]).sum(axis=1, dtype=np.int64)
            ok[at] = apart <= (n + m - 2 * least)[at]
        return ok


def _pairs(r: Run, starts: np.ndarray, rule: Rule):
    """Pairs (i, j), i before j, of one batch of whole groups that may link."""
    ends = np.append(starts[1:], len(r.fp))
    size = ends - starts
    row_end = np.repeat(ends, size)
    small = np.flatnonzero(np.repeat(size <= SMALL_RUN, size))
    for k in range(1, SMALL_RUN):
        small = small[small + k < row_end[small]]
        if not len(small):
            break
        ok = r.may_link(small, small + k, rule)
        yield small[ok], small[ok] + k
    for a, z in zip(starts[size > SMALL_RUN], ends[size > SMALL_RUN], strict=True):
        # sizes rise along the list: each row reads on to the last that is not too large
        stop = a + np.searchsorted(r.n[a:z], r.n[a:z] * rule.den // rule.num, "right")
        if r.lo[a] != r.hi[a]:      # two blocks: the later stands behind the earlier
            stop = np.full(z - a, z)
        for i in range(a, z, 256):
            rows = np.arange(i, min(i + 256, z))
            count = np.maximum(stop[rows - a] - rows - 1, 0)
            if not count.sum():
                continue
            left = np.repeat(rows, count)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
            for c in range(0, len(left), 1 << 18):
                x, y = left[c:c + (1 << 18)], right[c:c + (1 << 18)]
                ok = r.may_link(x, y, rule)
                yield x[ok], y[ok]


def united(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of i and j, pair by pair; ``parent`` names the least member of each."""
    while len(i):
        a, b = parent[i], parent[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def relatives(lists: DataFrame, rule: Rule) -> DataFrame:
    """Distinct pairs (x, y) of set names that span the sets that may link: of every list, each set with the first
    set of those it hangs together with. A list of m sets gives fewer than m pairs."""
    def run(batches):
        carry, seen = None, set()
        for b in batches:
            if not len(b):
                continue
            whole = pa.Table.from_batches([*([carry] if carry is not None else []), b]).combine_chunks()
            b = whole.to_batches()[0]
            key = [b.column(c).to_numpy() for c in ("token", "lo", "hi")]
            new = np.ones(len(b), bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
            starts = np.flatnonzero(new)
            carry = b.slice(int(starts[-1]))
            if len(starts) > 1:
                yield from emit(b.slice(0, int(starts[-1])), starts[:-1], seen)
        if carry is not None:
            yield from emit(carry, np.zeros(1, np.int64), seen)

    def emit(b: pa.RecordBatch, starts: np.ndarray, seen: set):
        r = Run(b)
        parent = np.arange(len(r.fp))
        for i, j in _pairs(r, starts, rule):
            united(parent, i, j)
        j = np.flatnonzero(parent != np.arange(len(parent)))
        yield from told(r.fp[parent[j]], r.fp[j], seen)

    def told(x: np.ndarray, y: np.ndarray, seen: set):
        """Pairs not told a moment ago: lists of one family repeat them."""
        fresh = []
        for p in zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), strict=True):
            if p[0] != p[1] and p not in seen:
                if len(seen) >= 1 << 17:
                    seen.clear()
                seen.add(p)
                fresh.append(p)
        if fresh:
            a = np.array(fresh)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["x", "y"])

    ordered = (block_pairs(lists, rule).repartition("token", "lo", "hi")
               .sortWithinPartitions("token", "lo", "hi", "block", "n", "fp"))
    return map_arrow(ordered, run, "x long, y long").distinct()


# ---- families --------------------------------------------------------------------------------------

def paired_blocks(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of families dealt into blocks by name (sizes: root, blocks), once for each two blocks (lo, hi) that
    meet; a family of one block meets once."""
    rows = (rows.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return rows.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other", "blocks")


def by_group(batches, of):
    """Apply ``of`` to each whole (root, lo, hi) group of sorted batches."""
    carry = None
    for b in batches:
        if not len(b):
            continue
        b = pa.Table.from_batches([*([carry] if carry is not None else []), b]).combine_chunks().to_batches()[0]
        key = [b.column(c).to_numpy() for c in ("root", "lo", "hi")]
        cuts = [0, *(np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1).tolist()]
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            yield from of(b.slice(a, z - a))
        carry = b.slice(cuts[-1])
    if carry is not None:
        yield from of(carry)


def refined(members: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(x, y) that span what may link inside families (members: fp, root), by bitmaps that suit the sets' sizes.

    The small bitmaps of the lists tell long sets apart badly, and long sets that only share a rare shingle would
    hang together in one family. Families of three sets or more with a long one are gone through again, pair by
    pair, with bitmaps folded to the smaller of the two; no linked pair is lost. Other families stay.
    """
    known = members.join(sets.select("fp", "n", F.coalesce("wide", "sig").alias("bits")), "fp")
    kinds = members.join(sets.select("fp", "n"), "fp").groupBy("root").agg(F.count("*").alias("c"), F.max("n").alias("most"))
    again = kinds.filter((F.col("c") > 2) & (F.col("most") >= LONG))
    rows = paired_blocks(known, again.select("root", F.ceil(F.col("c") / FAMILY).cast("int").alias("blocks")))

    def run(batches):
        yield from by_group(batches, family)

    def family(b: pa.RecordBatch):
        fp, n, block = (b.column(c).to_numpy() for c in ("fp", "n", "block"))
        raw = b.column("bits").to_pylist()
        words = np.array([len(x) // 8 for x in raw])
        kinds = [(w, np.flatnonzero(words == w)) for w in np.unique(words).tolist()]
        kinds = [(w, at, np.frombuffer(b"".join(raw[i] for i in at), np.uint64).reshape(-1, w)) for w, at in kinds]
        parent = np.arange(len(b))
        two = bool(b.column("lo")[0].as_py() != b.column("hi")[0].as_py())
        for k, (w, left, mine) in enumerate(kinds):
            for _, right, theirs in kinds[k:]:
                theirs = folded(theirs, w)
                for i, bits in zip(left.tolist(), mine, strict=True):
                    ok = np.minimum(n[i], n[right]) * rule.den >= np.maximum(n[i], n[right]) * rule.num
                    ok &= (parent[right] != parent[i]) & (right != i)
                    if two:
                        ok &= block[right] != block[i]
                    at = np.flatnonzero(ok)
                    apart = np.bitwise_count(theirs[at] ^ bits).sum(axis=1, dtype=np.int64)
                    total = n[i] + n[right[at]]
                    at = at[apart <= total - 2 * rule.least(total)]
                    united(parent, np.full(len(at), i), right[at])
        j = np.flatnonzero(parent != np.arange(len(b)))
        if len(j):
            yield pa.RecordBatch.from_arrays([pa.array(fp[parent[j]]), pa.array(fp[j])], ["x", "y"])

    keep = ["root", "lo", "hi", "block", "fp", "n", "bits"]
    ordered = rows.select(*keep).repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi", "fp")
    stay = members.join(again, "root", "left_anti").filter("fp <> root").select(
        F.col("root").alias("x"), F.col("fp").alias("y"))
    return stay.unionAll(map_arrow(ordered, run, "x long, y long"))


def linked(rule: Rule, total, apart):
    """Whether sets whose sizes sum to ``total`` and that differ in ``apart`` elements link."""
    return rule.den * (total - apart) >= rule.num * (total + apart)


def differences(members: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """(root, fp, n, near, apart) of every set of a family (members: fp, root, rep; docs: rep, text): its size,
    whether it links with the family's pivot (the set named like the family), and the elements that only one of
    the two has. Sets stream past their pivot; its text goes along once a piece of ``PIECE`` sets, every other
    text is sent once. Rows of a repeated id may differ: only a text that has the set counts, and once."""
    def run(batches):
        pivot, last = np.zeros(0, np.uint64), None
        for whole in batches:
            for lo in range(0, len(whole), 256):
                b = whole.slice(lo, 256)
                out: list[list] = [[], [], [], [], []]
                roots, names, member = (b.column(c).to_numpy(zero_copy_only=False) for c in ("root", "fp", "member"))
                for i, h in row_sets(b.column("text"), rule.words):
                    if not len(h) or member[i] and names[i] == last or fingerprint(h) != names[i]:
                        continue
                    if not member[i]:
                        pivot, last = h, None
                        continue
                    last = names[i]
                    apart = np.setxor1d(h, pivot, assume_unique=True)
                    for c, v in zip(out, (roots[i], names[i], len(h), linked(rule, len(h) + len(pivot), len(apart)),
                                          apart.tobytes()), strict=True):
                        c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()),
                                                    strict=True)], ["root", "fp", "n", "near", "apart"])

    pieces = members.groupBy("root").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("pieces"))
    texts = docs.join(members.join(pieces, "root"), "rep")
    own = F.struct(F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int").alias("piece"), F.lit(True).alias("member"))
    lead = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda p: F.struct(p.alias("piece"), F.lit(False).alias("member")))
    sent = F.when(F.col("fp") == F.col("root"), F.concat(lead, F.array(own))).otherwise(F.array(own))
    ordered = (texts.select("root", "fp", "text", F.explode(sent).alias("s")).select("root", "fp", "text", "s.piece", "s.member")
               .repartition("root", "piece").sortWithinPartitions("root", "piece", "member", "fp"))
    return map_arrow(ordered.select("root", "fp", "member", "text"), run,
                     "root long, fp long, n long, near boolean, apart binary")


def spanning_links(diffs: DataFrame, rule: Rule) -> DataFrame:
    """(x, y): links that span, together with those to the pivots, all links inside families.

    Only families with a set that does not link with its pivot are looked at. |x Δ y| is the size of the
    symmetric difference of the two sets' differences from the pivot, so neither text is needed; the common
    elements of one set's differences with those of all others are counted at once. Large families are dealt into
    blocks by name; every two blocks meet in a group, which gives fewer links than it has sets.
    """
    loose = diffs.filter("not near").select("root").distinct()
    rows = diffs.join(loose, "root", "left_semi")
    sizes = rows.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / FAMILY), F.ceil(F.sum(F.length("apart")) / HELD))
                                     .cast("int").alias("blocks"))
    rows = paired_blocks(rows, sizes)

    def run(batches):
        yield from by_group(batches, family)

    def family(b: pa.RecordBatch):
        fp, n, block = (b.column(c).to_numpy() for c in ("fp", "n", "block"))
        near = b.column("near").to_numpy(zero_copy_only=False).astype(bool)
        apart = [np.frombuffer(x, np.uint64) for x in b.column("apart").to_pylist()]
        size = np.array([len(x) for x in apart])
        ends = np.cumsum(size)
        at = np.unique(np.concatenate(apart), return_inverse=True)[1]
        holders = np.repeat(np.arange(len(b)), size)[np.argsort(at, kind="stable")]
        first = np.concatenate([[0], np.cumsum(np.bincount(at))]) if len(at) else np.zeros(1, np.int64)
        parent = np.arange(len(b))
        if near.any():                      # those are one component already; sorted first, so it is named by one
            parent[near] = np.flatnonzero(near)[0]
        two = bool(b.column("lo")[0].as_py() != b.column("hi")[0].as_py())
        for i in np.flatnonzero(~near):
            mine = at[ends[i] - size[i]:ends[i]]
            count = first[mine + 1] - first[mine]
            places = np.repeat(first[mine] - np.cumsum(count) + count, count) + np.arange(count.sum())
            common = np.bincount(holders[places], minlength=len(b))
            ok = linked(rule, n[i] + n, size[i] + size - 2 * common)
            ok[i] = False
            if two:
                ok &= block != block[i]
            j = np.flatnonzero(ok)
            united(parent, np.full(len(j), i), j)
        j = np.flatnonzero((parent != np.arange(len(b))) & ~near)
        if len(j):
            yield pa.RecordBatch.from_arrays([pa.array(fp[parent[j]]), pa.array(fp[j])], ["x", "y"])

    keep = ["root", "lo", "hi", "block", "fp", "n", "near", "apart"]
    ordered = rows.select(*keep).repartition("root", "lo", "hi").sortWithinPartitions(
        "root", "lo", "hi", F.desc("near"), "fp")
    return map_arrow(ordered, run, "x long, y long")


# ---- the join --------------------------------------------------------------------------------------

def link_documents(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the size of its set and the least doc_id it is linked
    to through any chain of pairs whose Jaccard similarity reaches the rule's.

    Equal sets are one node. A set lists its rarest shingles (the order of counters over all documents), and
    only sets that share a listed shingle can link. Lists are ordered by set size and read in blocks; pairs of
    blocks, places and sets that cannot link are skipped by size, position and bitmap, without loss. What hangs
    together by pairs that are left is a family; families with long sets are gone through once more with larger
    bitmaps. Every set of a family is compared with one pivot, whole text
    against whole text; all other answers are derived from the differences to the pivot, exactly. Every list and
    every group of differences gives fewer rows than it has sets, so rows grow with the sets, not with their pairs.
    Words and sets go by 64-bit hashes: two given sets that differ take each other's place with a chance of 2^-64.

    Empty sets (null or empty text, or no word) are linked with nothing and are their own component; rows of a
    repeated doc_id with different texts are each listed. Rows with a null doc_id name no component: they
    belong to that of rows with an equal set, and sets that only such rows have are linked with nothing (null
    name). An empty table gives an empty table.
    """
    profile = profiles(docs, rule)
    rows = profile.filter("block is null").select("doc_id", "n", "fp", "sig", "wide")
    sets = cut_lineage(rows.filter("n > 0").groupBy("fp").agg(
        F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("sig").alias("sig"), F.min("wide").alias("wide")), "sets")
    lists = index_lists(postings(docs, rule, frequencies(profile)))
    lists = cut_lineage(lists.join(sets.select("fp", "sig"), "fp"), "lists")
    members = components(relatives(lists, rule)).select(F.col("u").alias("fp"), "root")
    members = components(refined(members, sets, rule)).select(F.col("u").alias("fp"), "root")
    members = members.join(sets.select("fp", "rep"), "fp")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    diffs = cut_lineage(differences(members, texts, rule), "differences")
    stars = diffs.filter("near and fp <> root").select(F.col("fp").alias("x"), F.col("root").alias("y"))
    final = components(stars.unionAll(spanning_links(diffs, rule))).select(F.col("u").alias("fp"), "root")

    of = sets.select("fp", "rep").join(final, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = of.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = of.join(names, "root").select("fp", "component_id")
    full = rows.filter("n > 0").join(of, "fp").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionAll(rows.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
