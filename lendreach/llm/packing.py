"""Packing along a space-filling curve: neighbouring documents share training sequences."""

from __future__ import annotations

import json
import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendreach.llm.common import map_arrow
from lendreach.llm.utf8 import word_blocks

BUCKETS = 1024          # length of a hashed document vector
DIMS, BITS = 3, 12      # of the curve
PART_BYTES = 32 << 20   # text of a range of the curve
MAX_PARTS = 20_000
# fixed pattern of byte-level BPE: how text is cut before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_BLANK = re.compile(r"\s{5000}")


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of integer cells (rows x dimensions), by Gray-code rotation."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(high, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        flip = np.where(x[n - 1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(column: pa.Array) -> np.ndarray:
    """Hilbert key of every text: damped counts of hashed words, unit length, projected to ``DIMS`` numbers."""
    plane = np.random.default_rng(11).standard_normal((BUCKETS, DIMS))
    erf = np.vectorize(math.erf, otypes=[float])
    out = np.zeros(len(column), np.int64)
    for row, h, offs in word_blocks(column):
        n = len(offs) - 1
        doc = np.repeat(np.arange(n), np.diff(offs))
        spot = doc * BUCKETS + (h >> np.uint64(64 - 10)).astype(np.int64)
        v = np.log1p(np.bincount(spot, minlength=n * BUCKETS).reshape(n, BUCKETS))
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        share = 0.5 * (1 + erf(v @ plane / math.sqrt(2)))
        out[row:row + n] = hilbert(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))
    return out


class Ids:
    """Token ids of a byte-level BPE vocabulary file.

    Merges run in tiktoken when the file's merge order is its id order, which gives the same ids at three
    times the speed; other files, and texts with very long blank runs or with the literal of an added token,
    go through ``tokenizers`` as the file sets it up.
    """

    def __init__(self, vocabulary: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as f:
            data = json.load(f)
        vocab, special = data["model"]["vocab"], {t["content"] for t in data.get("added_tokens", ())}
        self.added = re.compile("|".join(map(re.escape, sorted(special)))) if special else None
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain} | {
            chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        made = [vocab.get("".join(m), -1) for m in merges]
        self.fast = None
        if (data.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and made == sorted(made) and made[0] >= 0 \
                and not data["pre_tokenizer"].get("add_prefix_space") and data.get("normalizer") is None:
            ranks = {bytes(shown[c] for c in t): i for t, i in vocab.items() if t not in special}
            self.fast = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is None or LONG_BLANK.search(text) or self.added and self.added.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=2)
def ids_of(vocabulary: str) -> Ids:
    return Ids(vocabulary)


def fill(docs, room: int):
    """Cut a stream of (doc_id, ids) into full sequences of ``room`` ids and, at its end, sequences whose
    lengths are falling powers of two, so that nothing is padded. Gives (sequence, offset, doc_id, start, ids,
    all of the document's ids)."""
    open_, used, seq = [], 0, 0

    def lay(pieces, lengths):
        nonlocal seq
        pieces, lengths = iter(pieces), list(lengths)
        at, left = 0, lengths.pop(0)
        for doc, start, ids, whole in pieces:
            while len(ids):
                part = ids[:left]
                yield seq, at, doc, start, part, whole
                ids, start, at, left = ids[len(part):], start + len(part), at + len(part), left - len(part)
                if not left:
                    seq += 1
                    at, left = 0, lengths.pop(0) if lengths else 0

    for doc, ids in docs:
        whole, start = len(ids), 0
        while start < whole:
            part = ids[start:start + room - used]
            open_.append((doc, start, part, whole))
            start, used = start + len(part), used + len(part)
            if used == room:
                yield from lay(open_, [room])
                open_, used = [], 0
    if used:
        yield from lay(open_, [1 << b for b in range(used.bit_length() - 1, -1, -1) if used >> b & 1])


SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def pack_documents(docs: DataFrame, vocabulary: str, room: int = 1024, part_bytes: int = PART_BYTES,
                   window: str | None = None) -> DataFrame:
    """Pieces of all documents, laid into sequences of at most ``room`` ids along a Hilbert curve.

    A document's ids are those of its whole text (null: empty) and an end id 0. Documents are range-partitioned
    by (curve key, doc_id): ties and copies stand by their id, and a key that many share is split between
    ranges. Each range is one stream of ids, cut where a sequence is full; only its end has shorter sequences,
    of power-of-two lengths. With ``window``, the name of a whole-number column, documents stand by it first, and
    the curve orders those of one window: sequences follow the windows. ``sequence_id`` is the range's number and a counter; ``ids`` holds the piece's
    ids as little-endian unsigned 32-bit integers. Repeated ids are documents of their own. An empty table
    gives no piece.
    """
    rows, schema = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id long, text string"
    order = ["curve", "doc_id"]
    if window:
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(window).cast("long").alias("window"))
        order, schema = ["window", *order], schema + ", window long"
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1)).first()[0] or 0
    parts = min(MAX_PARTS, max(1, -(-size // part_bytes)))

    def keyed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(curve_keys(b.column("text")))],
                                             [*b.schema.names, "curve"])

    def cut(batches):
        first = TaskContext.get().partitionId() << 32
        ids = ids_of(vocabulary)

        def stream():
            for b in batches:
                for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                    found = ids.encode(text.as_py() or "")
                    found.append(0)
                    yield doc, np.array(found, "<u4")

        out, held = [], 0
        for seq, at, doc, start, part, whole in fill(stream(), room):
            out.append((doc, start, len(part), whole, first + seq, at, part.tobytes()))
            held += len(part)
            if held >= 1 << 20:
                yield _batch(out)
                out, held = [], 0
        if out:
            yield _batch(out)

    ranged = (map_arrow(rows, keyed, schema + ", curve long")
              .repartitionByRange(parts, *order).sortWithinPartitions(*order, "text"))
    return map_arrow(ranged.select("doc_id", "text"), cut, SCHEMA)


def _batch(rows) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [*[pa.array(c, pa.int64()) for c in cols[:6]], pa.array(cols[6], pa.binary())],
        ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
