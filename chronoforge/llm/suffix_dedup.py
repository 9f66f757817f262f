"""Removal of repeated byte strings by a logarithmic family of sparse suffix arrays (operator 3).

Every byte covered by a ``span``-byte string (50) that also starts in a document with a smaller doc_id
is removed; strings are judged on the input.

* Sampled suffixes. In each window of ``span`` bytes the ``k``-byte string of least hash is its anchor:
  the choice depends on the window's bytes alone, so equal windows anywhere have equal anchors at
  equal places. Only suffixes that start at anchors are indexed (about 2 / (span - k + 2) of all).
  Consecutive windows of one anchor form an entry: (fingerprint of the anchor's k bytes, fingerprint of all
  bytes that the entry's windows cover, document, place, and one-byte prints of the anchor with half
  of the missing bytes to its left and to its right: a match of ``span`` bytes has one of the two).
* Index family. Entries are dealt to buckets by the anchor; the number of buckets follows the
  input. In a bucket new batches are sorted into a suffix array (by fingerprint: only equality of
  prefixes is asked, so any order that keeps equal prefixes together serves), merge-scanned
  against the existing levels, and pushed; levels of equal size merge, so each entry is merged log times.
* An entry whose whole cover occurs in a smaller document is removed at once. An entry that shares only
  its anchor and a side print (the edges of a match) is decided exactly: the fingerprints of all its
  windows are compared with those of every entry left of the same anchor and side.
* Hot passages. Before any shuffle, a slice of input keeps one entry of equal cover, with the
  smallest doc_id, and one of equal windows; the others are decided there. An anchor with more than
  ``HOT`` different covers in a slice goes straight to windows, which spread by their own hash.
  Whole copies of a text are decided by their digest and never enter the index.

Edge cases: a null or short text (under 50 bytes) loses nothing; a null doc_id counts as the smallest;
rows that repeat a doc_id are kept apart by the text's hash and are not smaller than each other; an
empty table gives an empty result. Only the id and text columns are read. Fingerprints have 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoforge.llm import kernels as K
from chronoforge.llm.common import BROADCAST_BYTES, batch_of, inputs, scratch, small, table_of

SPAN = 50
#: bytes of an anchor
ANCHOR = 24
#: bytes of text indexed at once
SLICE = 2 << 20
#: bytes of text fingerprinted at once: a slice's entries are few, its running sums are not
BLOCK = 1 << 18
#: index entries of one bucket on average, and of one batch of a bucket's family
BUCKET_ENTRIES = 250_000
BATCH_ENTRIES = 100_000
#: different covers of one anchor in one slice from which its windows are indexed instead
HOT = 64
NO_ID = -(1 << 63)

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = K.mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
_POWERS: dict[str, np.ndarray] = {}

_OUT = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("blob", pa.binary())])
_DDL = "kind int, part long, blob binary"
_ENTRY, _WINDOW, _GONE, _OPEN = 0, 1, 2, 3


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        m = max(n, BLOCK + 65536)
        with np.errstate(over="ignore"):
            for name, b in (("up", _BASE), ("down", _INVERSE)):
                p = np.full(m, b, np.uint64)
                p[0] = 1
                _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


class Prints:
    """Fingerprints of any range of a buffer from one running sum."""

    def __init__(self, buf: np.ndarray):
        up, self.down = _powers(len(buf) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(buf) + 1, np.uint64)
            np.cumsum(_VALUE[buf] * up[:len(buf)], out=self.sums[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return K.mix64((self.sums[hi] - self.sums[lo]) * self.down[lo])


def _blocks(texts: list[bytes]) -> list[tuple[int, int]]:
    """Runs of texts (first, end) of about ``BLOCK`` bytes together; a longer text is its own run."""
    return list(K.slices(np.fromiter(map(len, texts), np.int64, len(texts)) + 1, BLOCK))


def entries(texts: list[bytes], span: int = SPAN, k: int = ANCHOR):
    """The entries of some texts: text, first window, last window, anchor's print, cover's print, left
    and right side print (0: a text's edge is nearer)."""
    found = [(_block_entries(texts[a:z], span, k), a) for a, z in _blocks(texts) or [(0, 0)]]
    text = np.concatenate([x[0] + a for x, a in found])
    return text, *(np.concatenate(c) for c in list(zip(*(x for x, _ in found)))[1:])


def _block_entries(texts: list[bytes], span: int, k: int):
    buf, off = K.join_texts(texts)
    none = np.zeros(0, np.int64)
    nothing = none, none, none, none.view(np.uint64), none.view(np.uint64), none.astype(np.uint8), none.astype(np.uint8)
    if len(buf) < span:
        return nothing
    prints = Prints(buf)
    at = np.arange(len(buf) - k + 1)
    low = int(len(buf)).bit_length()
    key = (prints.of(at, at + k) >> np.uint64(low) << np.uint64(low)) | at.astype(np.uint64)
    width, size = span - k + 1, 1
    while size < width:  # least key of `size` neighbours, doubled
        step = min(size, width - size)
        key = np.minimum(key[:-step], key[step:])
        size += step
    anchor = (key & np.uint64((1 << low) - 1)).astype(np.int64)
    n_windows = np.maximum(np.diff(off) - 1 - span + 1, 0)
    valid = np.zeros(len(anchor) + 1, np.int8)
    full = n_windows > 0
    np.add.at(valid, off[:-1][full], 1)
    np.add.at(valid, off[:-1][full] + n_windows[full], -1)
    p = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    if not len(p):
        return nothing
    a = anchor[p]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)])
    last = np.r_[first[1:], len(p)] - 1
    lo, hi, a = p[first], p[last], a[first]
    text = np.searchsorted(off, lo, side="right") - 1
    with np.errstate(over="ignore"):
        kh = prints.of(a, a + k)
        cover = K.mix64(prints.of(lo, hi + span) + (a - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + kh)
    side = (span - k + 1) // 2
    near, far = np.maximum(a - side, 0), np.minimum(a + k + side, len(buf))
    left = (prints.of(near, a + k) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    right = (prints.of(a, far) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    left[a - side < off[text]] = 0
    right[a + k + side > off[text + 1] - 1] = 0
    return text, lo - off[text], hi - off[text], kh, cover, left, right


class Family:
    """Levels of suffix arrays of one bucket; ``covered`` and ``shared`` are marks by entry."""

    def __init__(self, n: int):
        self.levels: list[tuple[np.ndarray, ...]] = []
        self.covered, self.shared = np.zeros(n, bool), np.zeros(n, bool)

    @staticmethod
    def _array(kh, cover, doc, entry):
        o = np.lexsort((doc, kh))
        c = np.lexsort((doc, cover))
        head = np.r_[True, cover[c][1:] != cover[c][:-1]]
        return kh[o], doc[o], entry[o], cover[c][head], doc[c][head], cover[o]

    def insert(self, kh, cover, doc, entry) -> None:
        new = self._array(kh, cover, doc, entry)
        self._scan(new, new)
        for level in self.levels:
            self._scan(new, level)
            self._scan(level, new)
        self.levels.append(new)
        while len(self.levels) > 1 and 2 * len(self.levels[-1][0]) > len(self.levels[-2][0]):
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(self._array(*(np.r_[a[i], b[i]] for i in (0, 5, 1, 2))))

    def _scan(self, one, two) -> None:
        """Mark the entries of ``one`` that ``two`` covers, or whose anchor another document has there."""
        kh, doc, entry, _, _, cover = one
        at = np.minimum(np.searchsorted(two[3], cover), len(two[3]) - 1)
        self.covered[entry] |= (two[3][at] == cover) & (two[4][at] < doc)
        lo, hi = np.searchsorted(two[0], kh, side="left"), np.searchsorted(two[0], kh, side="right")
        some = hi > lo
        least, most = two[1][np.minimum(lo, len(two[1]) - 1)], two[1][np.maximum(hi - 1, 0)]
        self.shared[entry] |= some & ((least != doc) | (most != doc))


def _parts(kind: int, part: np.ndarray, key: tuple[np.ndarray, np.ndarray], row: np.ndarray, *arrays: np.ndarray):
    """One packed value for each part: the documents of its rows, and the rows with short references."""
    o = np.argsort(part, kind="stable")
    part, row, arrays = part[o], row[o], [x[o] for x in arrays]
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
    for lo, hi in zip(cut, [*cut[1:], len(part)]):
        rows, ref = np.unique(row[lo:hi], return_inverse=True)
        ref = ref.astype(np.uint16 if len(rows) <= 65536 else np.uint32)
        yield kind, int(part[lo]), K.pack(key[0][rows], key[1][rows], np.array([ref.itemsize], np.uint8), ref, *(x[lo:hi] for x in arrays))


def _open(blobs, *dtypes):
    """The rows of packed values: doc, t, arrays."""
    doc, t, out = [], [], [[] for _ in dtypes]
    for b in blobs:
        d, h, w, ref, *rest = K.unpack(b, np.int64, np.int64, np.uint8, np.uint8, *dtypes)
        ref = ref.view(np.uint16 if w[0] == 2 else np.uint32)
        doc.append(d[ref]), t.append(h[ref])
        for x, y in zip(out, rest):
            x.append(y)
    cat = lambda xs, dt: np.concatenate(xs) if xs else np.zeros(0, dt)
    return cat(doc, np.int64), cat(t, np.int64), *(cat(x, d) for x, d in zip(out, dtypes))


def _gone(key, row, lo, length, parts):
    """Ranges to remove, dealt by document."""
    part = (K.mix64(key[0].view(np.uint64))[row] % np.uint64(parts)).astype(np.int64)
    yield from _parts(_GONE, part, key, row, lo.astype(np.uint32), length.astype(np.uint32))


def _window_prints(texts: list[bytes], text, lo, hi, span: int):
    """Text, place and fingerprint of each of the windows lo..hi of some texts, block by block."""
    o = np.argsort(text, kind="stable")
    text, lo, hi = text[o], lo[o], hi[o]
    found = [(np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(0, np.uint64))]
    for a, z in _blocks(texts):
        s = slice(*np.searchsorted(text, [a, z]))
        n = hi[s] - lo[s] + 1
        if not len(n):
            continue
        buf, off = K.join_texts(texts[a:z])
        row = np.repeat(text[s], n)
        p = np.repeat(lo[s] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        at = off[row - a] + p
        found.append((row.astype(np.uint32), p.astype(np.uint32), Prints(buf).of(at, at + span)))
    return tuple(np.concatenate(c) for c in zip(*found))


def _window_rows(key, texts, text, lo, hi, buckets, parts, span):
    """Windows lo..hi of texts by their hash; of equal windows in this slice the smallest document's
    goes on, those of larger ones are decided here."""
    row, p, wh = _window_prints(texts, text, lo, hi, span)
    doc = key[0][row]
    o = np.lexsort((doc, wh))
    wh, doc, row, p = wh[o], doc[o], row[o], p[o]
    head = np.flatnonzero(np.r_[True, wh[1:] != wh[:-1]]) if len(wh) else np.zeros(0, np.int64)
    least = np.repeat(doc[head], np.diff(np.r_[head, len(wh)]))
    late = doc > least
    yield from _gone(key, row[late], p[late], np.full(int(late.sum()), span), parts)
    wh, row, p = wh[~late], row[~late], p[~late]
    yield from _parts(_WINDOW, (wh % np.uint64(buckets)).astype(np.int64), key, row, wh, p.astype(np.uint32))


def _keys(b: pa.RecordBatch, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    return (b.column("doc_id").slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(np.int64),
            b.column("t").slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(np.int64))


def _emit(rows):
    rows = list(rows)
    if rows:
        yield batch_of(_OUT, dict(zip(_OUT.names, zip(*rows), strict=True)))


def _index(buckets: int, parts: int, span: int, k: int):
    def slice_rows(key, texts):
        text, lo, hi, kh, cover, left, right = entries(texts, span, k)
        doc = key[0][text]
        o = np.lexsort((doc, cover))
        text, lo, hi, kh, cover, left, right, doc = (x[o] for x in (text, lo, hi, kh, cover, left, right, doc))
        head = np.flatnonzero(np.r_[True, cover[1:] != cover[:-1]]) if len(cover) else np.zeros(0, np.int64)
        least = np.repeat(doc[head], np.diff(np.r_[head, len(cover)]))
        late = doc > least
        yield from _gone(key, text[late], lo[late], (hi - lo)[late] + span, parts)
        u, count = np.unique(kh[head], return_counts=True)
        u = u[count > HOT]
        text, lo, hi, kh, cover, left, right = (x[~late] for x in (text, lo, hi, kh, cover, left, right))
        hot = np.isin(kh, u)
        if hot.any():
            yield from _window_rows(key, texts, text[hot], lo[hot], hi[hot], buckets, parts, span)
        mark = np.r_[kh[~hot], u]  # a hot anchor leaves a mark: an entry of length 0
        zero = np.zeros(len(u), np.int64)
        yield from _parts(
            _ENTRY, (mark % np.uint64(buckets)).astype(np.int64), key, np.r_[text[~hot], zero],
            (mark >> np.uint64(32)).astype(np.uint32), np.r_[cover[~hot], zero.view(np.uint64)],
            np.r_[lo[~hot], zero].astype(np.uint32), np.r_[(hi - lo)[~hot] + 1, zero].astype(np.uint8),
            np.r_[left[~hot], zero.astype(np.uint8)], np.r_[right[~hot], zero.astype(np.uint8)])

    def run(batches):
        for b in batches:
            for lo, hi, texts in K.text_slices(b.column("text"), SLICE):
                yield from _emit(slice_rows(_keys(b, lo, hi), texts))
        K.give_back()

    return run


def _family(parts: int, span: int):
    """One bucket: batches into the family of levels, then what is covered and what is open."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() != _ENTRY:  # decided in its slice: handed on
            return table
        doc, t, kh, cover, lo, n, left, right = _open(
            table.column("blob").to_pylist(), np.uint32, np.uint64, np.uint32, np.uint8, np.uint8, np.uint8)
        mark = n == 0
        hot = np.unique(kh[mark])
        doc, t, kh, cover, lo, n, left, right = (x[~mark] for x in (doc, t, kh, cover, lo, n, left, right))
        family = Family(len(kh))
        for at in range(0, len(kh), BATCH_ENTRIES):
            s = slice(at, at + BATCH_ENTRIES)
            family.insert(kh[s], cover[s], doc[s], np.arange(at, min(at + BATCH_ENTRIES, len(kh)), dtype=np.int32))
        gone, shared = family.covered, family.shared
        del family, cover
        K.give_back()
        # what is left of an anchor that other documents have too is open where a side agrees
        rest = np.flatnonzero(~gone & shared)
        open_ = ~gone & np.isin(kh, hot)
        for side in (left, right):
            o = rest[side[rest] > 0]
            both = kh[o].astype(np.uint64) << np.uint64(8) | side[o]
            by = np.lexsort((doc[o], both))
            o, both = o[by], both[by]
            head = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(o) else o
            size = np.diff(np.r_[head, len(o)])
            open_[o[np.repeat(doc[o][head] != doc[o][head + size - 1], size)]] = True
        key, row = (doc, t), np.arange(len(doc))
        rows = list(_gone(key, row[gone], lo[gone], n[gone].astype(np.int64) + span - 1, parts))
        part = (K.mix64(doc.view(np.uint64))[open_] % np.uint64(parts)).astype(np.int64)
        rows += _parts(_OPEN, part, key, row[open_], lo[open_], n[open_].astype(np.uint32))
        return table_of(_OUT, dict(zip(_OUT.names, zip(*rows), strict=True)) if rows else {c: [] for c in _OUT.names})

    return run


def _windows(parts: int, span: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() != _WINDOW:  # decided before: handed on
            return table
        doc, t, wh, p = _open(table.column("blob").to_pylist(), np.uint64, np.uint32)
        o = np.lexsort((doc, wh))
        wh, doc, t, p = wh[o], doc[o], t[o], p[o]
        head = np.flatnonzero(np.r_[True, wh[1:] != wh[:-1]]) if len(wh) else np.zeros(0, np.int64)
        late = doc > np.repeat(doc[head], np.diff(np.r_[head, len(wh)]))
        rows = list(_gone((doc, t), np.flatnonzero(late), p[late], np.full(int(late.sum()), span), parts))
        return table_of(_OUT, dict(zip(_OUT.names, zip(*rows), strict=True)) if rows else {c: [] for c in _OUT.names})

    return run


_RANGES = pa.schema([("doc_id", pa.int64()), ("t", pa.int64()), ("ranges", pa.binary())])


def _by_document(merge: bool):
    """Ranges (start, end) of each document of a part; ``merge`` joins overlapping and touching ones."""

    def run(table: pa.Table) -> pa.Table:
        doc, t, lo, n = _open(table.column("blob").to_pylist(), np.uint32, np.uint32)
        lo = lo.astype(np.int64)
        hi = lo + n
        o = np.lexsort((lo, t, doc))
        doc, t, lo, hi = doc[o], t[o], lo[o], hi[o]
        new = np.r_[True, (doc[1:] != doc[:-1]) | (t[1:] != t[:-1])]
        of = np.cumsum(new) - 1
        if merge:  # documents end far apart on one line, so that a running maximum stays within one
            shift = of * (int(hi.max()) + 2)
            reach = np.maximum.accumulate(hi + shift)
            start = np.flatnonzero(np.r_[True, (lo + shift)[1:] > reach[:-1]])
            end = np.r_[start[1:], len(lo)] - 1
            doc, t, of, lo, hi = doc[start], t[start], of[start], lo[start], (reach - shift)[end]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        r = np.stack([lo, hi], axis=1).astype(np.uint32)
        return table_of(_RANGES, {"doc_id": doc[first], "t": t[first],
                                  "ranges": [x.tobytes() for x in np.split(r, first[1:])]})

    return run


def _open_windows(buckets: int, parts: int, span: int):
    def run(batches):
        for b in batches:
            for a, z, texts in K.text_slices(b.column("text"), SLICE):
                key = _keys(b, a, z)
                r = [np.frombuffer(x, np.uint32).reshape(-1, 2).astype(np.int64) for x in b.column("ranges").slice(a, z - a).to_pylist()]
                text = np.repeat(np.arange(z - a), [len(x) for x in r])
                r = np.concatenate(r)
                yield from _emit(_window_rows(key, texts, text, r[:, 0], r[:, 1] - 1, buckets, parts, span))
        K.give_back()

    return run


def _attach(rows: DataFrame, ranges: DataFrame, how: str, sized: bool = True) -> DataFrame:
    """Ranges to their texts; broadcast only while their measured bytes are within the bound. Without
    ``sized`` (ranges of most documents) both sides shuffle at every size."""
    r = ranges.withColumnRenamed("doc_id", "__d").withColumnRenamed("t", "__t")
    if sized:
        n, size = ranges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("ranges")), F.lit(0))).first()
        r = small(r, size + 32 * n, BROADCAST_BYTES)
    else:
        r = r.hint("merge")
    return rows.join(r, (F.col("doc_id") == F.col("__d")) & (F.col("t") == F.col("__t")), how).drop("__d", "__t")


def removed_ranges(docs: DataFrame, span: int = SPAN, k: int = ANCHOR) -> DataFrame:
    """(doc_id, t, ranges) for documents that lose bytes: t is the text's xxhash64, ranges packed
    little-endian unsigned 32-bit (start, end) pairs. ``docs(doc_id, text, t)`` without nulls."""
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_entries = 2 * n_bytes / (span - k + 2)
    buckets = max(24, int(n_entries / BUCKET_ENTRIES))
    parts = max(24, int(n_bytes / 64e6))
    ddl_ranges = "doc_id long, t long, ranges binary"

    index = docs.mapInArrow(_index(buckets, parts, span, k), _DDL)
    judged = scratch(index.groupBy("kind", "part").applyInArrow(_family(parts, span), _DDL))
    open_ = scratch(judged.where(f"kind = {_OPEN}").groupBy("part").applyInArrow(_by_document(False), ddl_ranges))
    again = _attach(docs, open_, "inner", sized=False).mapInArrow(_open_windows(buckets, parts, span), _DDL)
    gone = judged.where(f"kind != {_OPEN}").unionByName(again).groupBy("kind", "part").applyInArrow(_windows(parts, span), _DDL)
    return gone.groupBy("part").applyInArrow(_by_document(True), ddl_ranges)


def cut(text: bytes, ranges: bytes | None) -> tuple[bytes, int, int]:
    """What is left of a text, bytes removed, ranges removed."""
    if not ranges:
        return text, 0, 0
    r = np.frombuffer(ranges, np.uint32).reshape(-1, 2)
    edge = [0, *r.ravel().tolist(), len(text)]
    left = b"".join(text[a:b] for a, b in zip(edge[::2], edge[1::2]))
    return left, len(text) - len(left), len(r)


def _plan(docs: DataFrame, span: int, k: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, text, t), whole copies (doc_id, t), ranges of the others."""
    rows = inputs(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("t", F.xxhash64("text"))
    digests = scratch(rows.select("doc_id", "t", F.sha2("text", 256).alias("s"), F.octet_length("text").alias("n")).where(f"n >= {span}"))
    first = scratch(digests.groupBy("s").agg(F.min("doc_id").alias("lo"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"))
    copies = scratch(digests.join(first, "s").where("doc_id > lo").select(
        "doc_id", "t", F.col("n").cast("long").alias("n")).distinct())
    keys = copies.select(F.col("doc_id").alias("__d"), F.col("t").alias("__t"))
    keys = small(keys, copies.count())
    own = rows.join(keys, (F.col("doc_id") == F.col("__d")) & (F.col("t") == F.col("__t")), "left_anti")
    ranges = removed_ranges(own, span, k)
    whole = copies.select("doc_id", "t", F.concat(
        F.lit(bytes(4)), *(F.unhex(F.lpad(F.hex(F.shiftright("n", s).bitwiseAND(F.lit(255))), 2, "0")) for s in (0, 8, 16, 24))).alias("ranges"))
    return rows, whole, ranges.unionByName(whole)


def _digest(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
    for b in batches:
        ids, ranges = b.column("doc_id").to_pylist(), b.column("ranges")
        for lo, hi, texts in K.text_slices(b.column("text")):
            got = [cut(x, r) for x, r in zip(texts, ranges.slice(lo, hi - lo).to_pylist())]
            yield batch_of(schema, {
                "doc_id": [None if i == NO_ID else i for i in ids[lo:hi]], "n_bytes": [len(x) for x in texts],
                "n_removed": [g[1] for g in got], "n_spans": [g[2] for g in got],
                "kept_sha256": [hashlib.sha256(g[0]).hexdigest() for g in got]})


def suffix_dedup(docs: DataFrame, span: int = SPAN, k: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row for each row of ``docs``."""
    rows, _, ranges = _plan(docs, span, k, id_col, text_col)
    return _attach(rows, scratch(ranges), "left").select("doc_id", "text", "ranges").mapInArrow(
        _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _left(batches):
    for b in batches:
        i = b.schema.get_field_index("__text")
        for lo, hi, texts in K.text_slices(b.column("__text"), SLICE):  # a batch's texts are not held twice
            part = b.slice(lo, hi - lo)
            valid, ranges = part.column("__text").is_valid().to_pylist(), part.column("ranges").to_pylist()
            out = [cut(x, r)[0].decode("utf-8", "ignore") if v else None for x, r, v in zip(texts, ranges, valid)]
            yield part.set_column(i, "__text", pa.array(out, pa.string())).drop_columns(["ranges"])
    K.give_back()


def cut_texts(docs: DataFrame, span: int = SPAN, k: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns and rows, with the repeated bytes cut from the text; characters that a cut
    splits go too."""
    _, _, ranges = _plan(docs, span, k, id_col, text_col)
    names = docs.columns
    keyed = docs.select(*(F.col(c).alias("__text" if c == text_col else f"c{i}") for i, c in enumerate(names)),
                        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("t"))
    joined = _attach(keyed, scratch(ranges), "left").drop("doc_id", "t")
    done = joined.mapInArrow(_left, joined.drop("ranges").schema)
    return done.select(*(F.col("__text" if c == text_col else f"c{i}").alias(c) for i, c in enumerate(names)))
