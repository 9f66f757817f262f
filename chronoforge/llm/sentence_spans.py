"""Substring deduplication by sliding sentence spans (operator 6).

A text is cut into sentences, at line feeds and behind ., ! or ? before white space. A passage that two texts
share seldom begins and ends with a sentence, and some texts have no sentence ends at all; so sentences of over
``LONG`` words are cut further, into parts of at most so many, at places that the words around them choose and
that are therefore the same in both texts. Every run of ``span`` consecutive parts, with as many more
as it takes to have ``LEAST`` words, is hashed in normal form (lower case, white space runs folded). Spans are
joined over the whole corpus: the first occurrence of a hash is the smallest (doc_id, place), and all parts
covered by any other occurrence are removed. n_removed counts the sentences that lose words.

The spans are made once and kept as a scratch table. Their join is a hash aggregate (count and least doc_id) that
folds a hot span to one row a task before it shuffles, and only spans that occur more than once are joined back;
that join's sides are plain exchanges, which AQE splits. What is found is kept as ranges of words and meets the texts in a
shuffled join at every size, never broadcast, so that disk grows with the input. Rows that
repeat a doc_id are told apart by the hash of their text; identical rows get the same result.

Edge cases: null or blank text has no sentence; a text with fewer parts than ``span``, or fewer words than ``LEAST``, loses
nothing; an empty table gives an empty result; a null doc_id counts as the smallest, like -2^63. Only the id and text
columns are read. Words are what ASCII white space parts. Spans are compared by a 64-bit and a 32-bit hash of their words.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoforge.llm.common import batch_of, inputs, scratch

SPAN = 3
#: fixed value: an empty match behind each sentence's end
CUT = r"(?<=\n)|(?<=[.!?])(?=\s)(?!\n)"
#: sentences of more words are cut into parts of at most so many, so that about 50 words hold three whole ones
LONG = 12
#: a cut inside a sentence is at a word whose hash is least among so many on either side
NEAR = 4
#: a span has at least so many words: 11 + 28 + 11 = 50, what parts of 12 words can lose at both ends of a passage of 50
LEAST = 28
#: texts are looked at in runs of about so many bytes
RUN_BYTES = 1 << 20

#: white space that does not part words
_ODD_SPACE = [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ODD = re.compile("|".join(map(chr, _ODD_SPACE)).encode())

_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_MARK = np.isin(np.arange(256), list(b".!?"))
_BYTE_BASE, _WORD_BASE, _WORD_BASE_2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo 2^64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Hashes:
    """Hashes of slices of a sequence, from prefix sums of x[i] * base^i modulo 2^64 (base is odd)."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, _powers(base, 0), _powers(1, 0)

    def __call__(self, x: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(x) >= len(self.up):
            self.up, self.down = _powers(self.base, len(x)), _powers(pow(self.base, -1, 1 << 64), len(x))
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x * self.up[: len(x)], out=sums[1:])
        return _mixed((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words:
    """The words and sentences of some texts (UTF-8): byte places in ``data``, numbers of words and of sentences."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.to = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1  # the end of each text
        space = _SPACE[self.data]
        before = np.r_[True, space[:-1]]
        self.start, self.end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
        self.first = np.r_[0, np.searchsorted(self.start, self.to)]  # the number of each text's first word
        lines = np.cumsum(self.data == 10, dtype=np.int64)
        n = len(self.start)
        new = np.ones(n + 1, bool)  # does a sentence begin here
        new[1:n] = _MARK[self.data[self.end[:-1] - 1]] | (lines[self.start[1:]] > lines[self.end[:-1] - 1])
        self.sentence = np.cumsum(new) - 1
        self.new = new

    def with_text(self) -> np.ndarray:
        """For each sentence, is there more in it than white space of any script."""
        out = np.ones(self.sentence[-1], bool)
        if ODD.search(whole := self.data.tobytes()):
            solid = [bool(whole[a:b].decode().strip()) for a, b in zip(self.start, self.end)]
            out = np.logical_or.reduceat(solid, np.flatnonzero(self.new)[:-1])
        return out


def _parts(words: _Words, h: np.ndarray, long: int = LONG) -> np.ndarray:
    """The numbers of the words that begin a part, and the number of words behind them."""
    n = len(h)
    new = words.new.copy()
    size = np.diff(np.flatnonzero(new))
    inside = np.repeat(size > long, size)
    before = np.where(new[:n], np.uint64(0), np.r_[np.uint64(0), h[:-1]])
    key, own = _mixed(h + before * np.uint64(_WORD_BASE)), words.sentence[:n]  # of a word and the one before, within its sentence
    least = inside.copy()
    for j in range(1, min(NEAR, n - 1) + 1):
        other = own[j:] != own[:-j]
        least[j:] &= other | (key[j:] < key[:-j])
        least[:-j] &= other | (key[:-j] <= key[j:])
    new[:n] |= least
    begin = np.flatnonzero(new)
    ago = np.arange(n) - np.repeat(begin[:-1], np.diff(begin))
    new[:n] |= inside & (ago % long == 0)
    return np.flatnonzero(new)


def spans_of(texts: list[bytes], span: int, hashes: tuple[_Hashes, ...]) -> tuple[np.ndarray, ...]:
    """(text, place, until, h, g) of each span of each text (in lower case); place and until count the text's words."""
    words = _Words(texts)
    if not len(words.start):
        return *(np.zeros(0, np.int64),) * 4, np.zeros(0, np.int32)
    of_byte, of_word, of_word_2 = hashes
    w = of_byte(words.data.astype(np.uint64), words.start, words.end)
    parts = _parts(words, w)
    text = np.searchsorted(words.first, parts, "right") - 1
    p = np.arange(len(parts) - 1)
    q = np.maximum(p + span, np.searchsorted(parts, parts[:-1] + LEAST))
    stop = words.first[text[:-1] + 1]  # the end of the text
    whole = q < len(parts)
    whole[whole] = parts[q[whole]] <= stop[whole]
    a, b, text = parts[p[whole]], parts[q[whole]], text[:-1][whole]
    at = words.first[text]
    return text, a - at, b - at, of_word(w, a, b).view(np.int64), (of_word_2(w, a, b) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _runs(texts: list[bytes]) -> Iterator[slice]:
    at = size = 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= RUN_BYTES or i + 1 == len(texts):
            yield slice(at, i + 1)
            at, size = i + 1, 0


def _spans(docs: DataFrame, span: int) -> DataFrame:
    """(doc_id, t, place, until, h, g) of each span of each text."""
    schema = pa.schema([("doc_id", pa.int64()), ("t", pa.int64()), ("place", pa.int32()), ("until", pa.int32()), ("h", pa.int64()), ("g", pa.int32())])

    def cut(batches):
        hashes = _Hashes(_BYTE_BASE), _Hashes(_WORD_BASE), _Hashes(_WORD_BASE_2)
        for batch in batches:
            texts = [x.lower().encode() for x in batch.column("text").to_pylist()]
            for run in _runs(texts):
                text, place, until, h, g = spans_of(texts[run], span, hashes)
                here = batch.slice(run.start, run.stop - run.start)
                yield pa.RecordBatch.from_arrays([here.column("doc_id").take(pa.array(text)), here.column("t").take(pa.array(text)),
                                                  pa.array(place, pa.int32()), pa.array(until, pa.int32()), pa.array(h), pa.array(g)], schema=schema)

    return _texts(docs).mapInArrow(cut, "doc_id long, t long, place int, until int, h long, g int")


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, t, text): a null text is an empty one; t is the hash of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("t"), text.alias("text"))


def repeated_ranges(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, t, ranges): the (place, until) of each text's non-first spans, words from place to before until."""
    spans = scratch(_spans(docs, span)).withColumn("d", F.coalesce("doc_id", F.lit(-(1 << 63))))
    again = scratch(spans.groupBy("h", "g").agg(F.min("d").alias("least"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"))
    met = scratch(spans.join(again, ["h", "g"]).withColumn("late", F.expr("d > least")).drop("d", "least"))
    # within the first document only the first place is the first occurrence
    own, where = met.where("NOT late"), F.struct("t", "place")
    first = own.groupBy("h", "g").agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    late = met.where("late").drop("late", "h", "g").unionByName(
        own.join(first, ["h", "g"]).where(where != F.col("first")).drop("late", "first", "h", "g"))
    return late.groupBy("doc_id", "t").agg(F.sort_array(F.collect_list(F.struct("place", "until"))).alias("ranges"))


def _left(words: _Words, solid: np.ndarray, text: int, place: np.ndarray, until: np.ndarray) -> tuple[bytes, int]:
    """What is left of a text without these ranges (sorted by place), and how many sentences lose words."""
    begin, to = 0 if text == 0 else words.to[text - 1] + 1, words.to[text]
    at, stop = words.first[text], words.first[text + 1]
    data, out, gone, kept, counted = words.data, [], 0, begin, -1  # the last sentence counted
    ends = np.maximum.accumulate(until)
    new = np.r_[True, place[1:] >= ends[:-1]]  # blank lines between two ranges stay
    head = np.flatnonzero(new)
    for a, b in zip(at + place[head], at + ends[np.r_[head[1:], len(new)] - 1]):
        gap = data[words.end[a - 1]: words.start[a]].tobytes() if a > at else data[begin: words.start[a]].tobytes()
        line = gap.rfind(b"\n") + 1
        from_ = words.start[a] if a > at and not words.new[a] else words.start[a] - len(gap) + line
        behind = words.start[b] if b < stop else to
        gap = data[words.end[b - 1]: behind].tobytes()
        if _MARK[data[words.end[b - 1] - 1]] and gap[:1] != b"\n":
            behind = words.end[b - 1]
        elif b"\n" in gap:
            behind = words.end[b - 1] + gap.index(b"\n") + 1
        out.append(data[kept:from_].tobytes())
        kept = behind
        s, e = words.sentence[a], words.sentence[b - 1]
        gone += np.count_nonzero(solid[max(s, counted + 1): e + 1])
        counted = e
    return b"".join(out) + data[kept:to].tobytes(), int(gone)


def sentence_spans(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """(doc_id, n_sentences, n_removed, kept_chars, kept_sha256), one row for each row of ``docs``; with
    ``keep_text`` also the text that is left."""
    docs = inputs(docs, id_col, text_col)
    found = scratch(repeated_ranges(docs, span)).select(F.col("doc_id").alias("__d"), F.col("t").alias("__t"), "ranges")
    joined = _texts(docs).join(found.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("t") == F.col("__t")), "left")
    schema = pa.schema([("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("kept_chars", pa.int64()),
                        ("kept_sha256", pa.string())] + [("text", pa.string())] * keep_text)

    def cut(batches):
        for batch in batches:
            texts = [x.encode() for x in batch.column("text").to_pylist()]
            for run in _runs(texts):
                words, here = _Words(texts[run]), batch.slice(run.start, run.stop - run.start)
                solid = words.with_text()
                left, gone, ranges = texts[run], [0] * (run.stop - run.start), here.column("ranges")
                for i in np.flatnonzero(ranges.is_valid().to_numpy(zero_copy_only=False)):
                    place, until = (ranges[int(i)].values.field(k).to_numpy() for k in (0, 1))
                    left[i], gone[i] = _left(words, solid, i, place, until)
                sentences = np.r_[0, np.cumsum(solid)][words.sentence[words.first]]
                decoded = [x.decode() for x in left]
                cols = {"doc_id": here.column("doc_id").to_pylist(), "n_sentences": np.diff(sentences), "n_removed": gone,
                        "kept_chars": [len(x) for x in decoded], "kept_sha256": [hashlib.sha256(x).hexdigest() for x in left]}
                yield batch_of(schema, cols | {"text": decoded} if keep_text else cols)

    ddl = "doc_id long, n_sentences long, n_removed long, kept_chars long, kept_sha256 string" + ", text string" * keep_text
    return joined.select("doc_id", "text", "ranges").mapInArrow(cut, ddl)
