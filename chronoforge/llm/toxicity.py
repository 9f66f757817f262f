"""Toxic spans and document scores by a linear-chain conditional random field (operator 1).

Tokens are words, lower-cased A-Z. A token's features are its word, its first four and five bytes and the
first five bytes of both neighbours. Only documents are labelled, so the training tokens are: a token of a
toxic document is toxic if one of its own features occurs in more toxic sample documents (no near copies of
each other) than chance allows, and nearly never in others. The field is fitted on a sample of at most ``SAMPLE`` documents of each
class (a documented bound); forward-backward marginals of all tokens of every whole text
give the offending offsets (marginal 0.5 or more) and, by their maximum and sum, the document score,
scaled by a logistic regression on the same sample.

Scoring is one pass without a shuffle; only the fitted weights are broadcast, at most one row per
feature of the bounded sample. Edge cases: null or empty text has no token and scores as a text without
a toxic one; without labels of both classes all scores are 0; repeated rows score alike; an empty table
gives an empty result; a null doc_id is carried and counts as not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoforge.llm import crf
from chronoforge.llm import kernels as K
from chronoforge.llm.common import batch_of, inputs
from chronoforge.llm.training import held_out, sample

#: labelled documents of each class that the model is fitted on at most
SAMPLE = 1500
#: sample documents in which a feature must occur
MIN_DOCS = 4
#: a feature is a sign of toxicity if its share of the toxic sample documents is so many times that of
#: the others, and further above it than so many standard errors
LIFT = 6.0
ERRORS = 5.0
STEPS = 30
THRESHOLD = 0.7
_BITS = 20


def token_hashes(texts: list[bytes]):
    """Feature hashes [3, n] of the words of all texts, their bounds, and the first word of each text."""
    buf, off = K.join_texts(texts)
    buf = K.lower_ascii(buf)
    start, end = K.word_bounds(buf)
    h = [K.span_hash(buf, start, end, 21)]
    for n in (4, 5):
        h.append(K.span_hash(buf, start, np.minimum(end, start + n), 21 + n))
    return np.stack(h), start, end, np.searchsorted(start, off), off


class Lexicon:
    """Features by hash; index 0 is every feature that the sample does not have."""

    def __init__(self, hashes: np.ndarray):
        self.slot, self.print = np.zeros(1 << _BITS, np.int32), np.zeros(1 << _BITS, np.uint32)
        at = (hashes >> np.uint64(64 - _BITS)).astype(np.int64)
        self.slot[at] = np.arange(1, len(hashes) + 1)
        self.print[at] = hashes.astype(np.uint32)
        self.size = len(hashes) + 1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - _BITS)).astype(np.int64)
        return np.where(self.print[at] == hashes.astype(np.uint32), self.slot[at], 0)


def _features(h: np.ndarray, first: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """Feature numbers [5, n]: own three, then the neighbours' (offset by the lexicon's size each)."""
    own = np.stack([lexicon.find(x) for x in h])
    near = own[2]
    before, after = np.append(0, near[:-1]), np.append(near[1:], 0)
    before[first] = 0
    after[:-1][first[1:]] = 0
    return np.concatenate([own, [before + lexicon.size, after + 2 * lexicon.size]])


def _summary(p: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Of each text: log-odds of the largest marginal, log of one and the sum."""
    n = len(bound) - 1
    top, total = np.zeros(n), np.zeros(n)
    some = np.flatnonzero(bound[1:] > bound[:-1])
    if len(some):
        top[some] = np.maximum.reduceat(p, bound[some])
        total[some] = np.add.reduceat(p, bound[some])
    top = np.clip(top, 1e-6, 1 - 1e-6)
    return np.column_stack([np.log(top / (1 - top)), np.log1p(total)])


def _firsts(bound: np.ndarray, n: int) -> np.ndarray:
    first = np.zeros(n, bool)
    first[bound[:-1][bound[:-1] < n]] = True
    return first


def fit_toxicity(rows: list[tuple[bytes, int]]):
    """(lexicon, weights, transitions, scale) of a sample of texts and labels; None without both classes."""
    y_doc = np.array([y for _, y in rows], np.int64)
    if not len(rows) or y_doc.min() == y_doc.max():
        return None
    h, _, _, bound, _ = token_hashes([t for t, _ in rows])
    n = h.shape[1]
    doc = np.repeat(np.arange(len(rows)), np.diff(bound))
    # near copies mostly share their least shingle: a feature counts once for all of them
    sets, at = K.shingle_sets([t for t, _ in rows])
    least = np.where(at[1:] > at[:-1], np.append(sets, np.uint64(0))[at[:-1]], np.uint64(0))
    _, kin = np.unique(np.stack([least, y_doc.astype(np.uint64)]), axis=1, return_inverse=True)
    kin = kin.reshape(-1)[doc]
    kin_toxic = len(np.unique(kin[y_doc[doc] == 1]))
    kin_other = len(np.unique(kin[y_doc[doc] == 0]))
    signs, seen = [], []
    for x in h:
        o = np.lexsort((kin, x))
        u, of = np.unique(x[o], return_inverse=True)
        new = np.append(True, (of[1:] != of[:-1]) | (kin[o][1:] != kin[o][:-1]))
        toxic = y_doc[doc[o][new]]
        n1 = np.bincount(of[new], toxic, len(u))
        n0 = np.bincount(of[new], 1 - toxic, len(u))
        s1, s0, both = n1 / max(kin_toxic, 1), n0 / max(kin_other, 1), (n1 + n0) / (kin_toxic + kin_other)
        error = np.sqrt(both * (1 - both) * (1 / max(kin_toxic, 1) + 1 / max(kin_other, 1))) + 1e-12
        signs.append(u[(n1 >= MIN_DOCS) & (s1 >= LIFT * s0) & (s1 - s0 >= ERRORS * error)])
        seen.append(u[n1 + n0 >= MIN_DOCS])
    lexicon = Lexicon(np.unique(np.concatenate(seen)))
    y = np.zeros(n, np.int64)
    for x, s in zip(h, signs):
        y |= np.isin(x, s)
    y &= y_doc[doc]
    first = _firsts(bound, n)
    ids = _features(h, first, lexicon).astype(np.int32)
    del h, doc, kin, sets
    size = 3 * lexicon.size + 1

    def score(w):
        e = np.full(n, w[-1])
        for row in ids:
            e += w[row]
        return e

    def gradient(d):
        g = np.zeros(size)
        for row in ids:
            g += np.bincount(row, d, size)
        g[[0, lexicon.size, 2 * lexicon.size]] = 0.0  # unseen features weigh nothing
        g[-1] = d.sum()
        return g

    w, trans = crf.fit(score, gradient, size, y, first, STEPS, 1e-7)
    p = crf.marginals(score(w), first, trans)
    return lexicon, w, trans, crf.logistic(_summary(p, bound), y_doc)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
             of: int = 3, rest: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans): spans are byte offsets (start, end) of toxic tokens."""
    docs = inputs(docs, id_col, text_col)
    model = fit_toxicity(sample(docs, labels, label, of, rest, SAMPLE, each=True))
    model = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("spans", span)])

    def run(batches):
        for b in batches:
            ids, out = b.column("doc_id").to_pylist(), b.column("held_out").to_pylist()
            for lo, hi, texts in K.text_slices(b.column("text")):
                score, spans = np.zeros(hi - lo), [[] for _ in texts]
                if model.value is not None:
                    lexicon, w, trans, scale = model.value
                    h, start, end, bound, off = token_hashes(texts)
                    first = _firsts(bound, h.shape[1])
                    e = w[_features(h, first, lexicon)].sum(0) + w[-1]
                    p = crf.marginals(e, first, trans)
                    z = _summary(p, bound)
                    score = crf.sigmoid(z @ scale[:-1] + scale[-1])
                    at = np.flatnonzero(p >= 0.5)
                    for d, a, z in zip((np.searchsorted(bound, at, side="right") - 1).tolist(), start[at].tolist(), end[at].tolist()):
                        spans[d].append({"start": a - int(off[d]), "end": z - int(off[d])})
                yield batch_of(schema, {"doc_id": ids[lo:hi], "held_out": out[lo:hi], "score": score,
                                        "predicted": (score >= THRESHOLD).astype(np.int32), "spans": spans})

    return docs.withColumn("held_out", held_out(of, rest)).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, spans array<struct<start: long, end: long>>")
