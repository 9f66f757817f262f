"""The dealt operators against brute force, on a table with nulls, empty and long texts, ties, repeated
rows and columns whose names the operators use themselves; and on an empty table."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronoforge.llm import byte_bpe as B
from chronoforge.llm import crf, kernels, packing
from chronoforge.llm.exact_dedup import drop_copies, exact_dedup
from chronoforge.llm.hilbert_sharding import hilbert_index, hilbert_shards
from chronoforge.llm.line_quality import line_quality
from chronoforge.llm.ngram_join import ngram_join
from chronoforge.llm.quality_rules import clean_texts, quality_rules
from chronoforge.llm.sentence_spans import CUT, sentence_spans
from chronoforge.llm.suffix_dedup import cut_texts, suffix_dedup
from chronoforge.llm.toxicity import toxicity

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, n long, key string, kind int, "
          "blob binary, t long, host string, words int, a long, b long, rank long, h long")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def _text(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    w = [f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, 19, n), rng.integers(0, 50, n))]
    return "".join(x + (".\n" if i % 12 == 11 else " ") for i, x in enumerate(w))


def _rows() -> list[tuple]:
    base, passage = _text(1, 120), _text(2, 60)
    near = base.replace(" ", " ", 1).split(" ")
    near[40] = "changed"
    texts = [
        (5, base), (3, base), (9, " ".join(near)), (10, _text(3, 90) + passage), (11, passage + _text(4, 70)),
        (12, None), (13, ""), (14, "   \n\t "), (15, "one two"), (16, "one two"), (17, "ONE two"), (18, "é" * 80), (19, "é" * 90),
        (20, _text(5, 4000)), (21, "na " * 300), (22, "na " * 200), (23, "don't 'stop'  now\r\n\r\n 3²x 🙂"), (None, base), (None, None), (24, _text(6, 60)),
    ]
    texts += [(24, _text(6, 60)), (25, _text(7, 55)), (25, _text(8, 55))]  # a repeated row; an id with two texts
    return [(i, t, None if i == 9 else "en", "s" if (i or 0) % 3 else None, None if t is None else len(t), 7, None, "k", 1,
             b"x", 3, "h", 2, 1, 2, 5, 6) for i, t in texts]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _bag(df) -> collections.Counter:
    return collections.Counter(tuple(r) for r in df.collect())


def test_exact_dedup(docs, rows, empty):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    want = collections.Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        once = True
        for i in ids:
            want[(i, keep, len(ids), i == keep and once, hashlib.sha256(text.encode()).hexdigest())] += 1
            once = once and i != keep
    assert _bag(exact_dedup(docs)) == want
    assert exact_dedup(empty).count() == 0
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["text"] or "") for r in kept.collect()) == sorted(groups)


def _ngrams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return set(zip(*[w[j:] for j in range(5)])) if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("rare", [32, 1])
def test_ngram_join(docs, rows, empty, rare):
    sets = [(r[0], _ngrams(r[1])) for r in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in sets:
        for j, y in sets:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    want = collections.Counter((i, len(x), None if i is None else find(i)) for i, x in sets)
    assert _bag(ngram_join(docs, rare=rare)) == want  # rare=1 sends every shared token to the combinations
    if rare > 1:
        assert ngram_join(empty).count() == 0


def test_suffix_dedup(docs, rows, empty):
    first = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            w = b[p:p + 50]
            first[w] = min(first.get(w, (1, 0)), (0, -1) if i is None else (0, i))
    want = collections.Counter()
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < ((0, -1) if i is None else (0, i)):
                gone[p:p + 50] = True
        left = bytes(x for x, g in zip(b, gone) if not g)
        runs = int(np.sum(np.diff(np.r_[0, gone.astype(int)]) == 1))
        want[(i, len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest())] += 1
    assert _bag(suffix_dedup(docs)) == want
    assert suffix_dedup(empty).count() == 0
    cut = cut_texts(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert sum(r["text"] is None for r in cut.collect()) == sum(r[1] is None for r in rows)


def test_quality_rules(docs, rows, empty):
    out = quality_rules(docs).collect()
    want = collections.Counter()
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        tri = collections.Counter(zip(w, w[1:], w[2:]))
        at = {k + j for k in range(len(w) - 2) if tri[tuple(w[k:k + 3])] > 1 for j in range(3)}
        want[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(at),
              len(w) < 50 or 100 * len(at) > 50 * len(w))] += 1
    assert collections.Counter(tuple(r)[:7] for r in out) == want
    assert not any(r["kept"] and r["base_failed"] for r in out)
    assert quality_rules(empty).count() == 0


def test_common_lines_deplete(spark):
    menu = "home about contact imprint and all other words that every page of this host repeats"
    rows = [(i, "\n".join([menu] * 6 + [_text(100 + i, 60)] * (i % 2)), "h") for i in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality_rules(d, max_lost=0.7).collect()}
    assert all(got[i]["removed_words"] == 6 * 15 for i in got if i % 2)
    assert all(got[i]["kept"] == bool(i % 2) for i in got if not got[i]["base_failed"])


def test_common_lines_leave_the_text(spark):
    menu = "Home  about contact"
    rows = [(i, f"{menu}\n{_text(300 + i, 60)}\n\n{menu.lower()} ", "en", "h" if i < 30 else "other" if i < 45 else None, 0, "k") for i in range(48)]
    rows += [(None, rows[0][1], "en", "h", 0, "k"), rows[1]]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, places string")
    want = collections.Counter()
    for i, t, lang, host, _, more in rows:
        lines = [x for x in t.split("\n") if host is None or " ".join(x.lower().split()) != menu.lower().replace("  ", " ")]
        want[(i, "\n".join(lines), lang, host, 0, more)] += 1
    assert _bag(clean_texts(d)) == want  # three documents without a host are too few for the limit


def test_near_copies_of_a_host_keep_the_first(spark):
    import corpus_pipeline as P

    menu, page = "home about contact", _text(400, 120).split("\n")
    short = (1, f"{page[0]}\n{menu}")  # smallest doc_id of a line, but fails the base rules
    group = [(i, "\n".join([*page[:i % 9], page[i % 9] + f" changed{i}", *page[i % 9 + 1:], menu])) for i in range(10, 260)]
    rest = [(i, f"{menu}\n{_text(500 + i, 60)}") for i in range(260, 760)]
    rows = [(i, t, "en", "h", len(t)) for i, t in [short, *group, *rest]]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(3)
    got = {r["doc_id"]: r for r in P.quality(spark, d, "").collect()}
    assert got[10]["text"] == group[0][1]  # the first of the group keeps all, with its menu
    assert set(got) == {10, *range(260, 760)}
    assert all(got[i]["text"] == t[len(menu) + 1:] and got[i]["n_chars"] == len(got[i]["text"]) for i, t in rest)
    assert not any(r["kept"] for r in quality_rules(d).where("doc_id < 260").collect())  # the SQL twin's rule


def test_sentence_spans(docs, rows, empty):
    span, parts, first = 3, [], {}
    cut = re.compile(CUT)
    for i, t, *_ in rows:
        raw = [x for x in cut.split(t or "")]
        own = [(k, " ".join(x.lower().split())) for k, x in enumerate(raw) if x.strip()]
        parts.append((i, t or "", raw, own))
        for k in range(len(own) - span + 1):
            key = tuple(x for _, x in own[k:k + span])
            first.setdefault(key, []).append((i is not None, i or 0, t or "", own[k][0]))
    sizes = collections.Counter(r["doc_id"] for r in sentence_spans(docs).collect())
    assert sizes == collections.Counter(r[0] for r in rows) and sentence_spans(empty).count() == 0
    got = {(r["doc_id"], r["text"]): r for r in sentence_spans(docs, keep_text=True).collect()}
    for i, t, raw, own in parts:
        gone = set()
        for k in range(len(own) - span + 1):
            seen = first[tuple(x for _, x in own[k:k + span])]
            if (i is not None, i or 0) > min(seen)[:2]:  # another document has it first
                gone |= set(range(own[k][0], own[k + span - 1][0] + 1))
        assert any(d == i for d, _ in got)
        if gone and len({s[:2] for s in first[tuple(x for _, x in own[:span])]}) > 1:
            left = "".join(x for k, x in enumerate(raw) if k not in gone)
            assert (i, left) in got


def test_byte_bpe(docs, rows, empty):
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = collections.Counter()
    for i, t, *_ in rows:
        ids = np.array(enc.encode_ordinary(t or ""), "<u4")
        want[(i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert _bag(B.byte_bpe(docs, path)) == want
    assert B.byte_bpe(empty, path).count() == 0
    cache, vocabulary = B.tokenizer(path)
    ids, _, _ = B.encode(["a bé c"], cache)
    assert B.id_offsets(ids, vocabulary)[-1] == 7

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.text(alphabet=st.sampled_from("ab' \n\t\r1!sretvlmdé  ²🙂x"), max_size=40), min_size=1, max_size=4))
    def same(texts):
        ids, first, _ = B.encode(texts, cache)
        assert [ids[a:z].tolist() for a, z in zip(first[:-1], first[1:])] == [enc.encode_ordinary(x) for x in texts]

    same()


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    want = collections.Counter()
    for i, x, *_ in rows:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        at, piece = 0, 0
        while at < len(ids):
            n = (len(ids) - at) % 1024 or 1024
            want[(i, piece, at, n, zlib.crc32(ids[at:at + n].tobytes()))] += 1
            at, piece = at + n, piece + 1
    got = packing.pack(docs, path).collect()
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in by.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:k]) for k in range(len(p))] and sum(n for _, n in p) <= 1024
    assert packing.pack(empty, path).count() == 0


def test_packing_added_tokens(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    end = "<|endoftext|>"
    texts = ["a " + end + " b", end, end * 3, f"x  {end}  y\n", f"don'{end}t <|endoftext| >", "plain", "", f"{_text(9, 900)}{end}{_text(10, 900)}"]
    assert 50256 in t.encode(texts[0], add_special_tokens=False).ids
    cache, vocabulary = B.tokenizer(path)
    ids, first, size = B.encode(texts, cache)
    got = [ids[a:z].tolist() for a, z in zip(first[:-1], first[1:])]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in texts] and size.sum() == len(ids)
    assert [B.decode(np.array(x, int), vocabulary).decode() for x in got] == texts
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lengths = {r["doc_id"]: r["n"] for r in packing.pack(d, path).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert lengths == {i: len(x) + 1 for i, x in enumerate(got)}

    @settings(max_examples=100, deadline=None)
    @given(st.lists(st.lists(st.sampled_from([end, "a", " ", "\n", "'s", "<|", "é", "1"]), max_size=12).map("".join), min_size=1, max_size=4))
    def same(texts):
        ids, first, _ = B.encode(texts, cache)
        assert [ids[a:z].tolist() for a, z in zip(first[:-1], first[1:])] == [t.encode(x, add_special_tokens=False).ids for x in texts]

    same()


def test_configuration_program():
    rng = np.random.default_rng(3)
    counts = np.zeros(1025, np.int64)
    np.add.at(counts, rng.integers(1, 1025, 30_000), 1)
    plan = packing.pack_histogram(counts)
    assert (sum(c * n for c, n in plan) == counts).all()
    assert max(int(c @ np.arange(1025)) for c, _ in plan) <= 1024
    assert sum(n for _, n in plan) <= 1.02 * -(-int(counts @ np.arange(1025)) // 1024)


def test_hilbert(docs, rows, empty):
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij")).reshape(3, -1)
    index = hilbert_index(grid, 3)
    path = grid[:, np.argsort(index)]
    assert sorted(index) == list(range(512)) and (np.abs(np.diff(path, axis=1)).sum(0) == 1).all()
    got = hilbert_shards(docs, shards=4).collect()
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    for s in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots))) and len(slots) in (len(rows) // 4, len(rows) // 4 + 1)
    curves = [max(r["curve"] for r in got if r["shard"] == s) for s in range(4)]
    assert curves == sorted(curves) and hilbert_shards(empty).count() == 0


def test_crf_marginals_by_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    e, trans = rng.normal(size=140) * 2, rng.normal(size=(2, 2))
    first = np.zeros(140, bool)
    first[[0, 6, 7, 130]] = True
    p = crf.marginals(e, first, trans)
    for lo, hi in ((0, 6), (6, 7), (130, 140)):
        total = np.zeros(hi - lo)
        z = 0.0
        for y in itertools.product((0, 1), repeat=hi - lo):
            w = np.exp(sum(a * b for a, b in zip(e[lo:hi], y)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            total, z = total + w * np.array(y), z + w
        assert np.allclose(p[lo:hi], total / z)


@pytest.mark.parametrize("op, label, of, rest", [(toxicity, "toxic", 3, 1), (line_quality, "quality", 4, 2)])
def test_classifiers_held_out(spark, docs, rows, empty, op, label, of, rest):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = op(d, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert ((zlib.crc32(str(int(got.doc_id[0])).encode()) % of) == rest)
    assert (got.predicted == got[label]).mean() > 0.97
    odd = op(docs, labels).collect()
    assert collections.Counter(r["doc_id"] for r in odd) == collections.Counter(r[0] for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in odd)
    assert op(empty, labels).count() == 0


def test_kernels_words():
    texts = [b"a b\x0bc", b"", " x y".encode(), b"\n\n"]
    buf, off = kernels.join_texts(texts)
    start, end = kernels.word_bounds(buf)
    assert [bytes(buf[a:z]) for a, z in zip(start, end)] == [b"a", b"b", b"c", " x".encode(), b"y"]
    h = kernels.span_hash(np.frombuffer(b"ab" * 200, np.uint8), np.array([0, 2, 1, 0]), np.array([2, 4, 3, 300]))
    assert h[0] == h[1] != h[2] and len(set(h.tolist())) == 3


def test_pipeline_by_stages(spark, rows, docs, tmp_path):
    import corpus_pipeline as P

    d = docs.select("doc_id", "text", "lang", "source", "n_chars")
    names = [n for n, _ in P.STAGES]
    assert names == ["quality_rules", "exact_dedup", "ngram_join", "suffix_dedup", "packing"] and P.ORACLE_SQL is None
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, d, "").write.parquet(str(tmp_path / f"s{k}"))
        out = spark.read.parquet(str(tmp_path / f"s{k}"))
        if k == 0:
            good = {(r["doc_id"], r["n_words"]) for r in quality_rules(d).collect() if r["kept"]}
            assert {(r["doc_id"], len((r["text"] or "").split())) for r in out.collect()} == good
        elif k == 1:
            assert sorted(r["text"] for r in out.collect()) == sorted({r["text"] for r in d.collect()})
        elif k == 2:
            roots = {r["component_id"] for r in ngram_join(d).collect()}
            assert {r["doc_id"] for r in out.collect()} == roots
        elif k == 3:
            left = {r["doc_id"]: r["n_bytes"] - r["n_removed"] for r in suffix_dedup(d).collect()}
            assert all(len(r["text"].encode()) <= left[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in out.collect())
        if k < 4:
            assert out.columns == d.columns
            d = out
        else:
            assert out.select(F.countDistinct("doc_id")).first()[0] == d.select(F.countDistinct("doc_id")).first()[0]
