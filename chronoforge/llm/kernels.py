"""NumPy kernels over batches of texts: byte buffers, words, hashes. No Spark in here; every
function takes the few megabytes of one Arrow batch slice and returns flat arrays."""

from __future__ import annotations

import ctypes
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text that a kernel handles at once; a longer text forms a slice of its own
SLICE_BYTES = 4 << 20
#: bytes of text whose shingles are hashed at once: the arrays on the way take many times as much
SHINGLE_BYTES = 1 << 19

#: white space of the word rule [^\x20\x09-\x0D]+
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: glibc's; None elsewhere
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system at the end of a task or group: a worker outlives them."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = np.asarray(x, np.uint64).copy()
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int = 1) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    with np.errstate(over="ignore"):
        i = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 7919)
    return mix64(i) | np.uint64(1)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def slices(sizes: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``limit`` bytes together (a single longer row is its own run)."""
    ends = np.cumsum(np.asarray(sizes, np.int64))
    lo = 0
    while lo < len(ends):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield lo, hi
        lo = hi


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, end row, texts) of each run of rows; only one run is held as Python objects."""
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lens = pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False)
    for lo, hi in slices(lens, limit):
        yield lo, hi, text_bytes(col.slice(lo, hi - lo))


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer, each followed by a line feed, and the offset of each (n + 1)."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=off[1:])
    return buf, off


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each word; the buffer must end with white space."""
    w = np.empty(len(buf) + 1, np.int8)
    w[0] = 0
    np.logical_not(_SPACE[buf], out=w[1:].view(bool))
    step = np.diff(w)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


#: spans up to this length are hashed eight bytes at a time
_SHORT_SPAN = 128
_MASK = np.array([(1 << 8 * i) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit multilinear hash of each span of bytes."""
    length = end - start
    h = length.astype(np.uint64)
    if not len(start):
        return h
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    load = np.ndarray((len(buf) + 1,), "<u8", buffer=padded, strides=(1,))
    k = constants(_SHORT_SPAN // 8 + 1, seed)
    h *= k[-1]
    short = length <= _SHORT_SPAN
    with np.errstate(over="ignore"):
        at = np.flatnonzero(short)
        for j in range(_SHORT_SPAN // 8):
            rest = length[at] - 8 * j
            at, rest = at[rest > 0], rest[rest > 0]
            if not len(at):
                break
            h[at] += mix64((load[start[at] + 8 * j] & _MASK[np.minimum(rest, 8)]) + k[j]) * k[j]
        at = np.flatnonzero(~short)
        if len(at):
            n, first = length[at], np.cumsum(length[at]) - length[at]
            within = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(first, n)
            value = (buf[within + np.repeat(start[at], n)].astype(np.uint64) + np.uint64(1)) * constants(int(n.max()), seed + 1)[within]
            h[at] += np.add.reduceat(value, first)
    return mix64(h)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def shingle_sets(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of the ``width``-word shingles of each text, one after the other,
    and the offset of each text. Fewer words: the whole sequence is the one shingle; none: empty."""
    out = []
    for lo, hi in slices(np.fromiter(map(len, texts), np.int64, len(texts)), SHINGLE_BYTES):
        out += _shingles(texts[lo:hi], width)
    ends = np.zeros(len(out) + 1, np.int64)
    np.cumsum([len(x) for x in out], out=ends[1:])
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), ends


def _shingles(texts: list[bytes], width: int) -> list[np.ndarray]:
    buf, off = join_texts(texts)
    buf = lower_ascii(buf)
    ws, we = word_bounds(buf)
    h = span_hash(buf, ws, we)
    first = np.searchsorted(ws, off)
    n_words = np.diff(first)
    k = constants(width, 5)
    n = len(h)
    with np.errstate(over="ignore"):
        s = np.zeros(max(n - width + 1, 0), np.uint64)
        for j in range(width):
            s += h[j:n - width + 1 + j] * k[j] if len(s) else np.uint64(0)
    s = mix64(s)
    out = []
    for d in range(len(texts)):
        a, m = first[d], n_words[d]
        if m == 0:
            got = s[:0]
        elif m < width:
            with np.errstate(over="ignore"):
                got = mix64(np.array([(h[a:a + m] * k[:m]).sum() + np.uint64(m)], np.uint64))
        else:
            got = s[a:a + m - width + 1].copy()
            got.sort()
            if len(got) > 1:
                keep = np.empty(len(got), bool)
                keep[0] = True
                np.not_equal(got[1:], got[:-1], out=keep[1:])
                got = got[keep]
        out.append(got if got.base is None else got.copy())  # not a view that keeps all of s
    return out


def pack(*arrays: np.ndarray) -> bytes:
    """Several arrays as one binary value: count, then the byte length of each, then the bytes."""
    parts = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return struct.pack(f"<{len(parts) + 1}I", len(parts), *map(len, parts)) + b"".join(parts)


def unpack(blob: bytes, *dtypes) -> list[np.ndarray]:
    n = struct.unpack_from("<I", blob)[0]
    sizes = struct.unpack_from(f"<{n}I", blob, 4)
    out, at = [], 4 * (n + 1)
    for size, dt in zip(sizes, dtypes, strict=True):
        out.append(np.frombuffer(blob, dt, count=size // np.dtype(dt).itemsize, offset=at))
        at += size
    return out
