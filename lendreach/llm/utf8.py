"""Words of Arrow string columns as 64-bit hashes, computed on the UTF-8 bytes of a whole batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20                     # bytes handled at once; bounds the memory of a task, not the text
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: also every ASCII character that is neither letter nor digit
BREAKS = SPACE.copy()
BREAKS[[c for c in range(128) if not chr(c).isalnum()]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null is the empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def _drawn(n: int) -> np.ndarray:
    """One factor for every place in a word, each mixed from its number: sums of bytes times such factors have no
    structure that a word could cancel, as it can with the powers of one base."""
    with np.errstate(over="ignore"):
        return mix(np.arange(n, dtype=np.uint64) * _BASE + np.uint64(0x632BE59BD9B4E019))


def _factors(n: int) -> np.ndarray:
    global _PLACE
    if len(_PLACE) < n:
        _PLACE = _drawn(max(n, 2 * len(_PLACE)))
    return _PLACE


_PLACE = _drawn(4096)


def _hashes(data: np.ndarray, first_rows: np.ndarray, gaps: np.ndarray,
            prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word; a word ends at a gap or where a row begins.

    With ``prefixes`` the hashes have a row for the words and one for each prefix length (in bytes),
    0 where the word is not longer than the prefix.
    """
    solid = ~gaps[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[first_rows] = solid[first_rows]
    start = np.flatnonzero(first)
    if not len(start):
        return np.zeros((1 + len(prefixes), 0) if prefixes else 0, np.uint64), start
    at = np.flatnonzero(solid)
    begins = first[at]
    place = at - start[np.cumsum(begins) - 1]
    value = _BYTE[LOWER[data[at]]] * _factors(int(place.max()) + 1)[place]
    cuts = np.flatnonzero(begins)
    length = np.diff(np.append(cuts, len(at))).astype(np.uint64)
    words = mix(np.add.reduceat(value, cuts) + length * np.uint64(0xD6E8FEB86659FD93))
    if not prefixes:
        return words, start
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value)])
    out = [words]
    for k in prefixes:
        h = mix(run[np.minimum(cuts + k, len(at))] - run[cuts] + np.uint64(k))
        h[length <= k] = 0
        out.append(h)
    return np.stack(out), start


def word_blocks(column: pa.Array, gaps: np.ndarray = SPACE,
                prefixes: tuple[int, ...] = ()) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, word offsets of the rows) for runs of rows of about ``BLOCK`` bytes.

    Letters A-Z are lower-cased; words are what stands between the bytes marked in ``gaps``. A row longer
    than the block comes alone: it is hashed piece by piece, cut at gaps, and its words are joined again.
    """
    data, offs = buffers(column)
    row, n = 0, len(offs) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + BLOCK, "right")) - 1)
        lo, hi = int(offs[row]), int(offs[end])
        if hi - lo <= 2 * BLOCK:
            inner = offs[row:end + 1] - lo
            begin = inner[:-1]
            h, start = _hashes(data[lo:hi], begin[begin < hi - lo], gaps, prefixes)
            yield row, h, np.searchsorted(start, inner)
        else:
            parts, a = [], lo
            while a < hi:
                z = min(a + BLOCK, hi)
                while z < hi and not gaps[data[z - 1]]:    # on to the end of the word
                    step = np.flatnonzero(gaps[data[z:min(z + BLOCK, hi)]])
                    z = z + int(step[0]) + 1 if len(step) else min(z + BLOCK, hi)
                parts.append(_hashes(data[a:z], np.zeros(1, np.int64), gaps, prefixes)[0])
                a = z
            h = np.concatenate(parts, axis=-1)
            yield row, h, np.array([0, h.shape[-1]])
        row = end


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of ``n`` words in a row; fewer words give one shingle, none give none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    n = min(n, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        h = (h + words[i:len(words) - n + 1 + i]) * _BASE
        h ^= h >> np.uint64(29)
    return np.unique(mix(h + np.uint64(n)))
