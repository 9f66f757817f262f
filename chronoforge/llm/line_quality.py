"""Document quality from a linear-chain conditional random field over lines (operator 9).

A text's lines that have a word form a chain. A line is described by its lengths, shares of letter cases,
digits, symbols and punctuation, repeated neighbouring words, three-word windows that the text repeats,
and whether the line occurred before; the features of the previous and the next line join them. The field
labels each line good or bad (a training line has its document's label), and the forward-backward
marginals, weighted by line length, make the document score, scaled by a logistic regression. It is
fitted on at most ``SAMPLE`` labelled documents (a documented bound, natural class shares); scoring is
one pass without a shuffle over whole texts.

Edge cases: null and empty text and text without a word score as a text whose lines are all bad; without
labels of both classes all scores are 0; repeated rows score alike; an empty table gives an empty
result; a null doc_id is carried and counts as not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chronoforge.llm import crf
from chronoforge.llm import kernels as K
from chronoforge.llm.common import batch_of, inputs
from chronoforge.llm.training import held_out, sample

#: labelled documents that the model is fitted on at most
SAMPLE = 6000
STEPS = 250
#: bytes of sample text whose lines are described at once
FIT_BYTES = 1 << 20
THRESHOLD = 0.7

_KINDS = np.zeros((256, 8), np.uint8)
_KINDS[65:91, 0] = 1
_KINDS[97:123, 1] = 1
_KINDS[48:58, 2] = 1
for _c in b"#*$%&|<>":
    _KINDS[_c, 3] = 1
for _c in b"!?":
    _KINDS[_c, 4] = 1
for _c in b".,;:":
    _KINDS[_c, 5] = 1
_KINDS[128:, 6] = 1
for _c in b"@/\\_=+~^{}[]()0123456789-":
    _KINDS[_c, 7] = 1
_OWN = 8 + 8


def line_features(texts: list[bytes]):
    """Features [n, 3 * _OWN] of the lines that have a word, their lengths, the first line of each text."""
    buf, off = K.join_texts(texts)
    ws, we = K.word_bounds(buf)
    edge = np.append(0, np.flatnonzero(buf == 10) + 1)  # each text ends with a line feed of its own
    lo = np.searchsorted(ws, edge[:-1])
    hi = np.searchsorted(ws, edge[1:])
    some = hi > lo
    lo, hi = lo[some], hi[some]
    begin, end = edge[:-1][some], edge[1:][some] - 1
    n = len(lo)
    if not n:
        return np.zeros((0, 3 * _OWN)), np.zeros(0), np.zeros(len(texts) + 1, np.int64)
    bound = np.searchsorted(begin, off)
    doc = np.searchsorted(off, begin, side="right") - 1
    size = (end - begin).astype(np.float64)
    out = np.empty((n, _OWN))
    for k in range(8):
        total = np.append(0, np.cumsum(_KINDS[buf, k], dtype=np.int64))
        out[:, k] = (total[end] - total[begin]) / size
    h = K.span_hash(K.lower_ascii(buf), ws, we, 31)
    words = (hi - lo).astype(np.float64)
    same = np.append(0, np.cumsum(np.append(False, h[1:] == h[:-1])))
    out[:, 8] = (same[hi] - same[np.minimum(lo + 1, hi)]) / words
    out[:, 9] = np.log1p(words) / 5
    out[:, 10] = np.log1p(size) / 7
    out[:, 11] = np.add.reduceat((we - ws).astype(np.float64), lo) / words / 10
    last = buf[we[hi - 1] - 1]
    out[:, 12] = (last == 46) | (last == 33) | (last == 63)
    # three-word windows that the text has more than once
    repeated = np.zeros(len(h) + 1)
    if len(h) > 2:
        k = K.constants(3, 37)
        of = doc[np.searchsorted(lo, np.arange(len(h)), side="right") - 1]
        with np.errstate(over="ignore"):
            w = K.mix64(h[:-2] * k[0] + h[1:-1] * k[1] + h[2:] * k[2] + of[:-2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        o = np.argsort(w, kind="stable")
        twin = np.append(False, w[o][1:] == w[o][:-1])
        twin[:-1] |= twin[1:].copy()
        hit = np.zeros(len(w), bool)
        hit[o] = twin
        hit &= of[:-2] == of[2:]
        repeated[1:len(w) + 1] = hit
    repeated = np.cumsum(repeated)
    out[:, 13] = (repeated[np.minimum(hi, len(repeated) - 1)] - repeated[lo]) / words
    line = K.mix64(K.span_hash(buf, begin, end, 41) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(line, return_index=True)
    out[:, 14] = 1.0
    out[at, 14] = 0.0
    out[:, 15] = 1.0
    before, after = np.zeros_like(out), np.zeros_like(out)
    inner = np.flatnonzero(doc[1:] == doc[:-1])
    before[inner + 1], after[inner] = out[inner], out[inner + 1]
    return np.concatenate([out, before, after], axis=1), size, bound


def _summary(p: np.ndarray, size: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Of each text: log-odds of the length-weighted marginal, and the log of its length."""
    n = len(bound) - 1
    mean, total = np.full(n, 1e-4), np.zeros(n)
    some = np.flatnonzero(bound[1:] > bound[:-1])
    if len(some):
        total[some] = np.add.reduceat(size, bound[some])
        mean[some] = np.add.reduceat(p * size, bound[some]) / total[some]
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    z = np.log(mean / (1 - mean))
    return np.column_stack([z, np.log1p(total) / 7, mean])


def fit_quality(rows: list[tuple[bytes, int]]):
    """(weights, transitions, scale) of a sample of texts and labels; None without both classes."""
    y_doc = np.array([y for _, y in rows], np.int64)
    if not len(rows) or y_doc.min() == y_doc.max():
        return None
    parts = []  # a few megabytes of text at once: the bytes' and words' arrays are many times their texts
    for lo, hi in K.slices(np.array([len(t) for t, _ in rows]), FIT_BYTES):
        x, size, bound = line_features([t for t, _ in rows[lo:hi]])
        parts.append((x.astype(np.float32), size, np.diff(bound)))
    x, size, counts = (np.concatenate(c) for c in zip(*parts))
    del parts
    bound = np.append(0, np.cumsum(counts))
    y = np.repeat(y_doc, np.diff(bound))
    first = np.zeros(len(y), bool)
    first[bound[:-1][bound[:-1] < len(y)]] = True
    w, trans = crf.fit(lambda w: (x @ w.astype(np.float32)).astype(np.float64), lambda d: (d.astype(np.float32) @ x).astype(np.float64), x.shape[1], y, first, STEPS, 1e-5, 0.1)
    p = crf.marginals((x @ w.astype(np.float32)).astype(np.float64), first, trans)
    return w, trans, crf.logistic(_summary(p, size, bound), y_doc)


def score_texts(texts: list[bytes], model) -> tuple[np.ndarray, np.ndarray]:
    """Document scores, and the share of lines labelled good."""
    if model is None:
        return np.zeros(len(texts)), np.zeros(len(texts))
    w, trans, scale = model
    x, size, bound = line_features(texts)
    first = np.zeros(len(x), bool)
    first[bound[:-1][bound[:-1] < len(x)]] = True
    p = crf.marginals(x @ w, first, trans)
    good = np.append(0, np.cumsum(p >= 0.5))
    z = _summary(p, size, bound)
    return crf.sigmoid(z @ scale[:-1] + scale[-1]), (good[bound[1:]] - good[bound[:-1]]) / np.maximum(np.diff(bound), 1)


def line_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
                 of: int = 4, rest: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted, good_lines): good_lines is the share of lines labelled good."""
    docs = inputs(docs, id_col, text_col)
    model = fit_quality(sample(docs, labels, label, of, rest, SAMPLE, each=False))
    model = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("good_lines", pa.float64())])

    def run(batches):
        for b in batches:
            ids, out = b.column("doc_id").to_pylist(), b.column("held_out").to_pylist()
            for lo, hi, texts in K.text_slices(b.column("text")):
                score, good = score_texts(texts, model.value)
                yield batch_of(schema, {"doc_id": ids[lo:hi], "held_out": out[lo:hi], "score": score,
                                        "predicted": (score >= THRESHOLD).astype(np.int32), "good_lines": good})

    return docs.withColumn("held_out", held_out(of, rest)).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, good_lines double")
