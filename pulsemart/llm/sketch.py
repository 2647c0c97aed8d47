"""Word and shingle hashes of whole texts, vectorised over Arrow batches.

A word's hash is a polynomial of its bytes modulo 2**64, read off prefix sums,
so no Python object is made per word; a 64-bit finaliser follows.  Texts are
taken in slices of a few megabytes cut between documents, so memory follows
the slice (or the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
BLOCK = 1 << 16
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_TRI = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, BLOCK)
        for key, base in (("p", _P), ("q", _P_INV)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[key] = np.cumprod(table, dtype=np.uint64)
    return _powers["p"], _powers["q"]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit changes about half of the output's."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows of a binary column with
    about SLICE_BYTES of text; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        end = min(len(column), max(end, row + 1))
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; words don't cross documents."""
    word = ~separator[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    prev = np.empty(len(data), dtype=bool)
    if len(data):
        prev[0] = False
        prev[1:] = word[:-1]
        starts = np.flatnonzero(word & (~prev | first[:-1]))
        nxt = np.zeros(len(data), dtype=bool)
        nxt[:-1] = word[1:]
        ends = np.flatnonzero(word & (~nxt | first[1:])) + 1
        return starts, ends
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, A-Z taken as lower case."""
    out = np.empty(len(starts), dtype=np.uint64)
    done = 0
    while done < len(starts):
        stop = max(done + 1, int(np.searchsorted(ends, starts[done] + BLOCK, "right")))
        lo, hi = starts[done], ends[stop - 1]
        p, q = _power(int(hi - lo) + 1)
        sums = np.zeros(int(hi - lo) + 1, dtype=np.uint64)
        np.cumsum((LOWER[data[lo:hi]].astype(np.uint64) + np.uint64(1)) * p[:hi - lo], out=sums[1:])
        s, e = starts[done:stop] - lo, ends[done:stop] - lo
        out[done:stop] = (sums[e] - sums[s]) * q[s]
        done = stop
    return mixed(out + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of fewer words, the whole run."""
    if not len(words):
        return words
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, np.uint64(width), dtype=np.uint64)
    for k in range(width):
        total = (total ^ words[k:len(words) - width + 1 + k]) * _TRI[k % len(_TRI)]
        total ^= total >> np.uint64(29)
    return mixed(total)


def documents(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of every document of a batch."""
    for row, data, offsets in slices(column):
        starts, ends = word_bounds(data, offsets)
        hashes = word_hashes(data, starts, ends)
        cuts = np.searchsorted(starts, offsets)
        for i in range(len(offsets) - 1):
            yield row + i, hashes[cuts[i]:cuts[i + 1]]


def random_odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def extremes(sets: list[np.ndarray], n_hashes: int, seed: int, maxima: bool) -> np.ndarray:
    """Per set the minimum under each of ``n_hashes`` permutations and, with
    ``maxima``, the maximum too, side by side.  Sets must not be empty."""
    width = 2 if maxima else 1
    out = np.empty((len(sets), n_hashes * width), dtype=np.uint64)
    a, b = random_odd(n_hashes, seed), random_odd(n_hashes, seed + 1)
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and (last == first or size + len(sets[last]) <= BLOCK):
            size += len(sets[last])
            last += 1
        part = sets[first:last]
        x = np.concatenate(part)
        at = np.concatenate(([0], np.cumsum([len(s) for s in part])[:-1]))
        for j in range(n_hashes):
            y = x * a[j]
            y ^= y >> np.uint64(32)
            y *= b[j]
            out[first:last, j * width] = np.minimum.reduceat(y, at)
            if maxima:
                out[first:last, j * width + 1] = np.maximum.reduceat(y, at)
        first = last
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """Each band of ``rows`` signature values as one 64-bit key."""
    n, width = signatures.shape
    total = np.zeros((n, width // rows), dtype=np.uint64)
    total += mixed(np.arange(1, width // rows + 1, dtype=np.uint64))
    for k in range(rows):
        total = mixed(total ^ signatures[:, k::rows][:, :width // rows])
    return total


def set_key(s: np.ndarray) -> bytes:
    """128 bits that name a set of distinct hashes, in any order."""
    return np.array([mixed(s).sum(dtype=np.uint64), mixed(s ^ _P).sum(dtype=np.uint64)], dtype=">u8").tobytes()
