"""Memory of the Python side of the pipeline's tasks: arrays on the way must not grow with a whole slice or batch."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from chronoforge.llm import kernels as K
from chronoforge.llm import ngram_join as N
from chronoforge.llm import suffix_dedup as S
from chronoforge.llm.common import small_batches


def _texts(n_bytes, size=4000):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(5000)]
    out, total = [], 0
    while total < n_bytes:
        out.append(" ".join(rng.choices(words, k=size // 6)).encode())
        total += len(out[-1])
    return out


def _peak(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / (1 << 20)
    finally:
        tracemalloc.stop()


def test_entries_of_a_slice_take_little_memory():
    texts = _texts(S.SLICE)
    S.entries(texts[:1])  # tables that are made once
    assert _peak(lambda: S.entries(texts)) < 64


def test_windows_of_a_slice_are_the_same_in_blocks():
    texts = _texts(3 * S.BLOCK // 2) + [b"", b"short"]
    buf, off = K.join_texts(texts)
    text = np.array([len(texts) - 3, 0, 0, 5])
    lo, hi = np.array([3, 10, 0, 7]), np.array([9, 30, 4, 7])
    row, p, wh = S._window_prints(texts, text, lo, hi, S.SPAN)
    at = off[row] + p
    assert sorted(zip(row.tolist(), p.tolist())) == sorted((t, w) for t, a, z in zip(text.tolist(), lo, hi) for w in range(a, z + 1))
    assert (wh == S.Prints(buf).of(at, at + S.SPAN)).all()


def test_shingles_of_a_slice_take_little_memory():
    texts = _texts(K.SLICE_BYTES)
    assert _peak(lambda: K.shingle_sets(texts)) < 48
    v, ends = K.shingle_sets(texts)
    for d in (0, len(texts) // 2, len(texts) - 1):
        assert (v[ends[d]:ends[d + 1]] == K.shingle_sets(texts[d:d + 1])[0]).all()


def test_signatures_count_tokens_in_bounded_runs(monkeypatch):
    monkeypatch.setattr(N, "COUNT_TOKENS", 1000)
    texts = ["a b c d e f"] * 40 + ["x" + str(i) + " y z u v w" for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    got = pa.Table.from_batches(list(N._signatures(0.01)([batch])))
    heavy = {i: n for k, i, n in zip(*(got[c].to_pylist() for c in ("kind", "id", "n"))) if k == 1}
    hot = K.shingle_sets([b"a b c d e f"])[0].view(np.int64).tolist()
    assert got["kind"].to_pylist().count(0) == len(texts) and all(heavy.get(t) == 40 for t in hot)


def test_small_batches_hold_inside_only(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    df = spark.range(2000, numPartitions=1).selectExpr("id", "repeat('x', 1000) AS text").mapInArrow(count, "n long")
    assert [r[0] for r in df.collect()] == [2000]
    with small_batches(spark, 100_000):
        sizes = [r[0] for r in df.select("n").collect()]
    assert sum(sizes) == 2000 and max(sizes) < 200 and spark.conf.get(name) == before
