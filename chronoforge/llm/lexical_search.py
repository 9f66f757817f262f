"""Ranked lexical search over a length-stratified index (operator 11).

A document's score depends on its length only through the normaliser m, and on a term's occurrences only
through tf. So documents of equal m form a stratum, and within a stratum a term's postings are grouped by
tf: the impact (1000000000 * tf) div (1000 * tf + 8 * m) is computed once for each tf of the stratum, not
for each posting.

Build: one pass counts the terms of each document (N and L, and the sizes of strata); a second pass collects
small postings lists per task and stratum, which are shuffled by (m, part) and merged into blocks of about
``BLOCK_DOCS`` documents of one stratum. A stratum that holds a third of all documents has many parts. The
index is a table in the shared folder; every document is in it.

Search: the terms of the items (in blocks of bounded size) go to all tasks. One pass over the index's terms
counts df; the first block of each stratum is then searched, which gives each item a lower bound of its
tenth score, and the other blocks after it. A task visits its blocks in the order of the item's stratum
bound, the sum over its terms of weight times the impact of the block's largest tf, and stops at the first
bound below the tenth score so far. Nothing with a score that could be among the ten is skipped, so results
are exact. A task returns ten rows an item at most.

Edge cases: a null or empty text has no terms and is found by no item; it counts neither for N nor for L. A
null doc_id counts like any other and comes last among equal scores. Repeated rows are documents of their
own, repeated items are ranked each. An item without terms, or an empty table on either side, gives no rows.
Terms are compared by 64-bit hashes. Only the id and text columns are read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoforge.llm.common import batch_of, inputs, scratch, table_of
from chronoforge.llm.kernels import pack, text_slices, unpack

#: documents of a block on average, at most; and terms of a block, unless one document has more
BLOCK_DOCS = 1024
BLOCK_TERMS = 250_000
#: postings that a task collects before it sends them on
FLUSH_POSTINGS = 500_000
#: bytes of index blocks that a task weighs against each other before it visits them
VISIT_BYTES = 8 << 20
#: terms of all items that are searched together
ITEM_TERMS = 500_000
#: entries of a task's memory of term hashes
MEMO = 100_000

_NO_ID = np.iinfo(np.int64).max
_SEPARATORS = {*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}
_TERMS = bytes(b + 32 if 65 <= b <= 90 else 32 if b in _SEPARATORS else b for b in range(256))
_BLOCK = pa.schema([("m", pa.int64()), ("part", pa.int64()), ("n_docs", pa.int64()), ("block", pa.binary())])
_BLOCK_SQL = "m long, part long, n_docs long, block binary"
_HITS_SQL = "item long, doc_id long, score long"
_HITS = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
_DTYPES = ("<i8", "<u8", "<u4", "<u4", "<u4")


def terms(text: bytes) -> list[bytes]:
    """The maximal runs of digits, ASCII letters (lower-cased) and bytes of other characters."""
    return text.translate(_TERMS).split()


class _Hashes(dict):
    """Hash of each term seen, with bounded memory."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[term] = xxhash.xxh3_64_intdigest(term)
        return h


def normaliser(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 90 + (90 * n * n_docs) // n_terms


@dataclass
class LexicalIndex:
    """N, L and the table (m, part, n_docs, block). A block packs the doc_ids, the sorted term hashes, the
    postings of each term (end offsets), and each posting's tf and place of its document, by falling tf."""

    n_docs: int
    n_terms: int
    blocks: DataFrame


def _lengths(docs: DataFrame) -> DataFrame:
    """(n, c): documents by their number of terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = Counter(len(terms(t)) for _, _, texts in text_slices(b.column("text")) for t in texts)
            yield pa.RecordBatch.from_pydict({"n": list(c), "c": list(c.values())}, schema=pa.schema([("n", pa.int64()), ("c", pa.int64())]))

    return docs.select("text").mapInArrow(run, "n long, c long").groupBy("n").agg(F.sum("c").alias("c"))


def _block(ids: np.ndarray, term: np.ndarray, tf: np.ndarray, doc: np.ndarray) -> bytes:
    """One block of postings (term, tf, place of the document), by term, falling tf and place."""
    order = np.lexsort((doc, -tf.astype(np.int64), term))
    term, tf, doc = term[order], tf[order], doc[order]
    last = np.flatnonzero(np.append(term[1:] != term[:-1], len(term) > 0))
    return pack(ids.astype("<i8"), term[last].astype("<u8"), (last + 1).astype("<u4"), tf.astype("<u4"), doc.astype("<u4"))


def _opened(block: bytes) -> tuple[np.ndarray, ...]:
    return tuple(unpack(block, *_DTYPES))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS) -> LexicalIndex:
    """The index of all rows of ``docs``, written to the shared folder."""
    docs = inputs(docs, id_col, text_col)
    lengths = scratch(_lengths(docs).where("n > 0"))
    total = lengths.agg(F.sum("c").cast("long"), F.sum(F.col("n").cast("decimal(38,0)") * F.col("c"))).first()
    n_docs, n_terms = int(total[0] or 0), int(total[1] or 0)
    # strata of more than one block: at most N / block_docs + L / BLOCK_TERMS of them, and fewer than there are lengths
    wide = _wide_strata(lengths, n_docs, n_terms, block_docs)

    def flush(held: dict, nth: int) -> Iterator[dict]:
        for m, docs_ in held.items():
            ids = np.array([i for i, _, _ in docs_], np.int64)
            tf = np.concatenate([t for _, _, t in docs_])
            term = np.concatenate([t for _, t, _ in docs_])
            place = np.repeat(np.arange(len(docs_)), [len(t) for _, t, _ in docs_])
            yield {"m": m, "part": zlib.crc32(f"{ids[0]} {len(ids)} {nth}".encode()) % wide.get(m, 1), "n_docs": len(ids), "block": _block(ids, term, tf, place)}

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, size, nth = _Hashes(), defaultdict(list), 0, 0
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for lo, _, texts in text_slices(b.column("text")):
                for k, text in enumerate(texts):
                    words = terms(text)
                    if not words:
                        continue
                    tf = Counter(words)
                    i = ids[lo + k]
                    held[normaliser(len(words), n_docs, n_terms)].append((
                        _NO_ID if i is None else i, np.fromiter((memo[t] for t in tf), np.uint64, len(tf)), np.fromiter(tf.values(), np.uint32, len(tf))))
                    size += len(tf)
                if size >= FLUSH_POSTINGS:
                    yield from _rows(flush(held, nth))
                    held, size, nth = defaultdict(list), 0, nth + 1
        yield from _rows(flush(held, nth))

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        ids, term, tf, doc, base = [], [], [], [], 0
        # in an order of the content, so that a task that is run again makes the same block
        for block in sorted(table.column("block").to_pylist()):
            i, u, end, t, d = _opened(block)
            ids.append(i)
            term.append(np.repeat(u, np.diff(end, prepend=np.uint32(0))))
            tf.append(t)
            doc.append(d + np.uint32(base))
            base += len(i)
        merged = _block(*map(np.concatenate, (ids, term, tf, doc)))
        return table_of(_BLOCK, {"m": [key[0].as_py()], "part": [key[1].as_py()], "n_docs": [base], "block": [merged]})

    parts = docs.mapInArrow(postings, _BLOCK_SQL)
    return LexicalIndex(n_docs, n_terms, scratch(parts.groupBy("m", "part").applyInArrow(merge, _BLOCK_SQL)))


def _rows(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Blocks as batches of some megabytes."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r["block"])
        if size > 4 << 20:
            yield pa.RecordBatch.from_pylist(held, schema=_BLOCK)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_BLOCK)


def _wide_strata(lengths: DataFrame, n_docs: int, n_terms: int, block_docs: int) -> dict[int, int]:
    """Parts of each stratum that has more than one: enough for ``block_docs`` documents and ``BLOCK_TERMS`` terms a part."""
    if not n_docs:
        return {}
    # a stratum unites the lengths with one value of m; in decimals, as 90 * n * N can pass 64 bits
    m = F.expr(f"10 + CAST((CAST(n AS DECIMAL(38,0)) * {90 * n_docs}) DIV {n_terms} AS LONG)")
    strata = lengths.groupBy(m.alias("m")).agg(F.sum("c").alias("c"), F.sum(F.col("n") * F.col("c")).alias("t"))
    parts = F.greatest(F.ceil(F.col("c") / block_docs), F.least(F.ceil(F.col("t") / BLOCK_TERMS), F.col("c"))).alias("parts")
    return {r["m"]: r["parts"] for r in strata.select("m", parts).where("parts > 1").collect()}


@dataclass
class _Items:
    """The items of one block of the query set, as arrays that every task gets."""

    keys: list[int]
    vocab: np.ndarray     #: sorted term hashes of all items
    term: np.ndarray      #: each item's terms as places in vocab, one item after the other
    start: np.ndarray     #: first term of each item (n + 1)
    weight: np.ndarray    #: of each term of vocab

    def bounds(self, at: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Largest score that any document of a block can have, for each item; ``at`` and ``impact`` are the
        terms of vocab that the block has and their largest impact there."""
        top = np.zeros(len(self.vocab), np.int64)
        top[at] = self.weight[at] * impact
        sums = np.append(np.cumsum(top[self.term]), 0)
        return sums[self.start[1:] - 1] - np.where(self.start[:-1] > 0, sums[self.start[:-1] - 1], 0)


def _impact(tf: np.ndarray, m: int) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class _Stratum:
    """One block of a stratum with the terms of the vocabulary that it has; what it keeps besides the block grows
    with those terms, not with the vocabulary."""

    def __init__(self, m: int, block: bytes, items: _Items) -> None:
        self.ids, known, end, self.tf, self.doc = _opened(block)
        self.m = m
        found = np.minimum(np.searchsorted(known, items.vocab), max(len(known) - 1, 0))
        self.at = np.flatnonzero(known[found] == items.vocab) if len(known) else np.zeros(0, np.int64)
        mine = found[self.at]
        self.begin, self.end = np.where(mine > 0, end[mine - 1], 0).astype(np.int64), end[mine].astype(np.int64)
        self.bound = items.bounds(self.at, _impact(self.tf[self.begin], m))  # the first posting of a term has its largest tf
        self.impacts: dict[int, np.ndarray] = {}

    def impact(self, k: int) -> np.ndarray:
        """Impacts of a term's postings: one value for each tf, repeated over the documents that share it."""
        got = self.impacts.get(k)
        if got is None:
            tf = self.tf[self.begin[k]:self.end[k]]
            cut = np.flatnonzero(np.append(True, tf[1:] != tf[:-1]))
            got = self.impacts[k] = np.repeat(_impact(tf[cut], self.m), np.diff(np.append(cut, len(tf))))
        return got

    def scores(self, words: np.ndarray, weight: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.ids), np.int64)
        slots = np.searchsorted(self.at, words)
        for w, k in zip(words.tolist(), slots.tolist()):
            if k < len(self.at) and self.at[k] == w:
                out[self.doc[self.begin[k]:self.end[k]]] += weight[w] * self.impact(k)
        return out


class _Best:
    """An item's best documents so far and the score that a further one must reach."""

    def __init__(self, k: int, least: int) -> None:
        self.k, self.least = k, max(least, 1)
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = scores >= self.least
        if not keep.any():
            return
        ids, scores = np.append(self.ids, ids[keep]), np.append(self.scores, scores[keep])
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids, self.scores = ids[order], scores[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


def _visit(blocks: DataFrame, items: _Items, least: list[int], k: int) -> DataFrame:
    """(item, doc_id, score): each task's best k documents of each item, those at or above ``least``."""

    def visit(strata: list[_Stratum], best: list[_Best]) -> None:
        bounds = np.stack([s.bound for s in strata], axis=1)
        for i, b in enumerate(best):
            words = items.term[items.start[i]:items.start[i + 1]]
            for s in np.argsort(-bounds[i], kind="stable"):
                if bounds[i, s] < b.least:
                    break
                b.add(strata[s].ids, strata[s].scores(words, items.weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held, size = [_Best(k, x) for x in least], [], 0
        for batch in batches:
            for m, block in zip(batch.column("m").to_pylist(), batch.column("block").to_pylist()):
                held.append(_Stratum(m, block, items))
                size += len(block) + held[-1].bound.nbytes
                if size > VISIT_BYTES:
                    visit(held, best)
                    held, size = [], 0
        if held:
            visit(held, best)
        yield batch_of(_HITS, {
            "item": [items.keys[i] for i, b in enumerate(best) for _ in b.ids],
            "doc_id": [None if x == _NO_ID else x for b in best for x in b.ids.tolist()],
            "score": [x for b in best for x in b.scores.tolist()]})

    return blocks.select("m", "block").mapInArrow(run, _HITS_SQL)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _document_frequency(blocks: DataFrame, vocab: np.ndarray) -> dict[int, int]:
    """df of the terms of ``vocab`` that the index has; at most ``ITEM_TERMS`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocab), np.int64)
        for batch in batches:
            for block in batch.column("block").to_pylist():
                _, known, end, _, _ = _opened(block)
                _, mine, theirs = np.intersect1d(vocab, known, assume_unique=True, return_indices=True)
                df[mine] += np.diff(end.astype(np.int64), prepend=0)[theirs]
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], names=["term", "df"])

    return {r["term"]: r["df"] for r in blocks.select("block").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}


def _query_blocks(items: DataFrame, item_terms: int) -> Iterator[list]:
    """Rows (item, terms) of the items that have a term, in blocks of about ``item_terms`` terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Hashes()
        for b in batches:
            found = [np.unique(np.fromiter((memo[t] for t in set(terms(x))), np.uint64)) for _, _, texts in text_slices(b.column("text")) for x in texts]
            yield pa.RecordBatch.from_pydict({"item": b.column("item").to_pylist(), "n": [len(f) for f in found], "terms": [f.tobytes() for f in found]},
                                             schema=pa.schema([("item", pa.int64()), ("n", pa.int64()), ("terms", pa.binary())]))

    found = scratch(items.mapInArrow(run, "item long, n long, terms binary").where("n > 0"))
    total = found.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // item_terms)
    for b in range(blocks):
        rows = found.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).orderBy("item").collect()
        if rows:
            yield rows


def search(index: LexicalIndex, items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = 10,
           item_terms: int = ITEM_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each row of ``items`` with a score above 0."""
    spark = items.sparkSession
    numbered = scratch(items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
                       .withColumn("item", F.monotonically_increasing_id()))
    found = spark.createDataFrame([], "item long, doc_id long, score long, rank int")
    for rows in _query_blocks(numbered.select("item", "text"), item_terms):
        if not index.n_docs:
            break
        each = [np.frombuffer(bytes(r["terms"]), np.uint64) for r in rows]
        vocab = np.unique(np.concatenate(each))
        df = _document_frequency(index.blocks, vocab)
        weight = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(vocab))], np.int64)
        asked = _Items([r["item"] for r in rows], vocab, np.searchsorted(vocab, np.concatenate(each)),
                       np.cumsum([0] + [len(t) for t in each]), weight)
        first = scratch(_ranked(_visit(index.blocks.where("part = 0"), asked, [1] * len(rows), k), k))
        # k rows an item at most: the k-th best score of part of the documents bounds the k-th best of all
        tenth = {r["item"]: r["score"] for r in first.where(F.col("rank") == k).select("item", "score").collect()}
        more = _visit(index.blocks.where("part > 0"), asked, [tenth.get(i, 1) for i in asked.keys], k)
        found = found.unionByName(scratch(_ranked(first.drop("rank").unionByName(more), k)))
    return (numbered.select("item", "item_id").join(found, "item")
            .select("item_id", "rank", "doc_id", "score"))
