"""Operators 11 to 13 against brute force, on tables with nulls, empty and long texts, ties, repeated rows,
columns with clashing names, dense groups, and on empty tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronoforge.llm import lexical_search as S
from chronoforge.llm import prefix_trie as T
from chronoforge.llm import simhash_near as H

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
DOCS = "doc_id long, text string, fp long, key long, m long, part long, n long, block binary, item long, rank long, least long"


def _text(seed: int, n: int, spread: int = 8) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, 19, n), rng.integers(0, spread, n)))


def _documents(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, b"x", 6, 7, 8) for i, t in texts], DOCS).repartition(3)


# ---------------------------------------------------------------------------------------------
# 11. Ranked lexical search
# ---------------------------------------------------------------------------------------------


def _lower(text: str) -> str:
    return re.sub("[A-Z]", lambda c: c.group().lower(), text)


def _bm25(docs, items, k=10):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    tfs = [(i, collections.Counter(cut.findall(_lower(t or "")))) for i, t in docs]
    tfs = [(i, c) for i, c in tfs if c]
    n_docs, total = len(tfs), sum(sum(c.values()) for _, c in tfs)
    df = collections.Counter(t for _, c in tfs for t in c)
    out = collections.Counter()
    for item, text in items:
        asked, scored = set(cut.findall(_lower(text or ""))), []
        for i, c in tfs:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored)[:k], 1):
            out[(item, rank, i, -score)] += 1
    return out


def test_lexical_search_equals_brute_force(spark):
    texts = [(i, _text(i, 5 + 7 * (i % 9))) for i in range(120)] + [(500 + i, "Tau1 tau1 ALPHA2") for i in range(40)]
    texts += [(200, None), (201, ""), (202, " .,;\n"), (203, "É tau1 naïve É_naïve 🙂"), (None, _text(4, 30)), (7, _text(7, 54)), (7, _text(7, 54)), (204, _text(9, 30000))]
    items = [(1, _text(3, 20)), (2, "tau1"), (3, None), (4, "--- ..."), (5, "no such term here"), (6, "É naïve 🙂 TAU1"), (7, _text(50, 400)), (1, "alpha2"), (8, _text(9, 25))]
    docs = _documents(spark, texts)
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, item long, score long")
    want = _bm25(texts, items)
    for block, terms in ((S.BLOCK_DOCS, S.ITEM_TERMS), (8, 60)):  # one block a stratum; many parts and several blocks of items
        index = S.build_index(docs, block_docs=block)
        assert index.blocks.agg(F.sum("n_docs")).first()[0] == len(texts) - 3  # every document with a term
        got = S.search(index, asked, item_terms=terms)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert collections.Counter(tuple(r) for r in got.collect()) == want


def test_wide_strata_have_many_parts(spark):
    docs = _documents(spark, [(i, f"same{i % 5} length text{i}") for i in range(300)])
    index = S.build_index(docs.repartition(40), block_docs=20)
    sizes = [r["n_docs"] for r in index.blocks.collect()]
    assert sum(sizes) == 300 and len(sizes) > 8 and max(sizes) < 100


def test_stratum_bound_is_an_upper_bound():
    rng = np.random.default_rng(0)
    ids = np.arange(50)
    rows = sorted({(int(t), int(d)) for t, d in zip(rng.integers(1, 30, 400), rng.integers(0, 50, 400))})
    term, doc = (np.array(x) for x in zip(*rows))
    block = S._block(ids, term.astype(np.uint64), rng.integers(1, 9, len(rows)).astype(np.uint32), doc.astype(np.uint32))
    vocab = np.array([2, 5, 7, 11, 40], np.uint64)
    items = S._Items([0, 1], vocab, np.array([0, 1, 2, 3, 4, 4]), np.array([0, 5, 6]), np.array([900, 20, 3000, 1, 8]))
    s = S._Stratum(60, block, items)
    for i, words in ((0, [0, 1, 2, 3, 4]), (1, [4])):
        assert s.scores(np.array(words), items.weight).max() <= s.bound[i]
    assert s.bound[1] == 0


def test_lexical_search_of_empty_tables(spark):
    none = _documents(spark, [(1, "a b")]).limit(0)
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert S.search(S.build_index(none), items).count() == 0
    assert S.search(S.build_index(_documents(spark, [(1, None), (2, "")])), items).count() == 0
    assert S.search(S.build_index(_documents(spark, [(1, "a b")])), items.limit(0)).count() == 0


# ---------------------------------------------------------------------------------------------
# 12. SimHash near-duplicates
# ---------------------------------------------------------------------------------------------


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _classes(prints):
    """Component of each position of a list of fingerprints, by comparing all pairs."""
    comp = list(range(len(prints)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                comp[b] = a
    return [root(i) for i in range(len(prints))]


def test_simhash_near_equals_brute_force(spark):
    base = _text(1, 200, 50).split()
    texts = [(10 + i, " ".join(base[:i] + ["changed"] + base[i + 1:])) for i in range(0, 150, 2)]  # a dense group of near copies
    texts += [(1000 + i, _text(100 + i, 30, 50)) for i in range(60)] + [(2000 - i, _text(100, 30, 50)) for i in range(5)]
    texts += [(3, None), (2, ""), (4, " \t\n"), (5, "one"), (6, "ONE"), (7, "one two"), (8, "É two three"), (None, base[0]), (None, None), (9, _text(5, 40000)), (9, "x y z"), (9, "x y z")]
    prints = [_fingerprint(t) for _, t in texts]
    roots = _classes(prints)
    ids = collections.defaultdict(list)
    for (i, _), r in zip(texts, roots):
        if i is not None:
            ids[r].append(i)
    want = collections.Counter((i, f"{p:016x}", min(ids[r], default=None)) for (i, _), p, r in zip(texts, prints, roots))
    got = H.simhash_near(_documents(spark, texts))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert collections.Counter(tuple(r) for r in got.collect()) == want
    assert len(set(roots)) < len(set(prints)) < len(texts)  # some links join different fingerprints


def test_links_connect_exactly_what_is_within_two_bits(spark):
    rng = np.random.default_rng(3)
    prints = {int(x) for x in rng.integers(0, 1 << 64, 150, dtype=np.uint64)}
    seeds = sorted(prints)
    for n, flips in ((60, 1), (60, 2), (120, 3), (60, 4)):
        prints |= {seeds[int(rng.integers(0, 20))] ^ sum(1 << int(b) for b in rng.choice(64, flips, replace=False)) for _ in range(n)}
    prints |= {0, (1 << 64) - 1, 1 << 63, 3, (1 << 63) | (1 << 15), 7}
    prints = sorted(prints)
    rows = spark.createDataFrame([(H._signed(p),) for p in prints], "fp long")
    comp = {p: r for p, r in zip(prints, _classes(prints))}
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in H.links(rows).collect()]
    assert all(comp[a] == comp[b] for a, b in edges)
    linked = collections.defaultdict(set)
    for a, b in edges:
        linked[a].add(b)
        linked[b].add(a)
    for p in prints:  # everything of a component is reached over the edges
        seen, todo = {p}, [p]
        while todo:
            new = linked[todo.pop()] - seen
            seen |= new
            todo += new
        assert seen == {q for q in prints if comp[q] == comp[p]}


def test_links_grow_with_the_fingerprints_of_a_dense_group(spark):
    """All 2,081 fingerprints within two bits of one: their edges are no more than the centres allow."""
    ball = {0} | {1 << a for a in range(64)} | {1 << a | 1 << b for a in range(64) for b in range(a)}
    rows = spark.createDataFrame([(H._signed(p),) for p in ball], "fp long")
    assert len(ball) == 2081 and H.links(rows).count() <= 64 * len(ball)


@given(st.integers(0, (1 << 64) - 1), st.integers(0, 63), st.integers(0, 63))
@settings(max_examples=200, deadline=None)
def test_every_pair_within_two_bits_shares_a_chain_key_with_both_bits_open(p, a, b):
    q = p ^ (1 << a) ^ (1 << b) if a != b else p ^ (1 << a)

    def keys(x):
        out = {}
        for tag, (i, j) in enumerate(H._tags()):
            turned = ((x >> 16 * i) | (x << 64 - 16 * i)) & ((1 << 64) - 1)
            out[tag] = turned & ((1 << 48) - 1) & ~(255 << 16 + 8 * j)
        return out

    kp, kq = keys(p), keys(q)
    shared = [H.open_bits(*H._tags()[tag]) for tag in kp if kp[tag] == kq[tag]]
    assert any(a in bits and b in bits for bits in shared)


def test_simhash_of_an_empty_table(spark):
    assert H.simhash_near(_documents(spark, [(1, "a")]).limit(0)).count() == 0


# ---------------------------------------------------------------------------------------------
# 13. Conversation prefix trie
# ---------------------------------------------------------------------------------------------


def _trie(rows):
    turns = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in turns.items()}
    paths = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:])
    members = collections.defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = collections.defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = collections.Counter()

    def walk(p):
        leaves = saved = 0
        for q in kids[p]:
            a, b = walk(q)
            leaves, saved = leaves + a, saved + b
        leaves = leaves or 1
        saved += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        ends = ",".join(map(str, sorted(c for c in members[p] if paths[c] == p)))
        out[(min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())] += 1
        return leaves, saved

    if paths:
        walk(())
    return out


def _conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x", 4) for r in rows],
                                 "conv_id long, turn long, role string, text string, conv long, pos long, h long, head string, block long").repartition(4)


def _talks():
    rng = np.random.default_rng(1)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(-130, -95), 205, 207, 4100, 4101, 9999999]:
        for t in range(int(rng.integers(0, 9))):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"say {rng.integers(0, 3)} " + "é" * int(rng.integers(0, 3))))
    rows += [(300, t, "user", f"long {t}") for t in range(400)] + [(301, t, "user", f"long {t}") for t in range(400)]  # two long ones, alike
    rows += [(302, t, "user", f"long {t if t < 150 else -t}") for t in range(260)]
    rows += [(400 + c, 0, "system", "all the same first turn") for c in range(90)]
    rows += [(500, None, None, None), (500, 1, None, "b"), (500, 1, "a", None), (500, 1, "a", None), (501, 5, "", ""), (None, 1, "x", "y"), (None, None, None, None)]
    return rows


def test_prefix_trie_equals_brute_force(spark):
    rows = _talks()
    got = T.prefix_trie(_conversations(spark, rows))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert collections.Counter(tuple(r) for r in got.collect()) == _trie(rows)


def test_prefix_trie_over_small_shards(spark, monkeypatch):
    """Shards of two conversations and eight positions give the same trie."""
    rows = [r for r in _talks() if r[0] is None or not 300 <= r[0] <= 302] + [(300 + c, t, "user", f"long {t}") for c in (0, 1, 5) for t in range(33 - c)]
    monkeypatch.setattr(T, "SHARD_BITS", 1)
    monkeypatch.setattr(T, "SHARD_TURNS", 8)
    assert collections.Counter(tuple(r) for r in T.prefix_trie(_conversations(spark, rows)).collect()) == _trie(rows)


def test_prefix_trie_edges(spark):
    assert T.prefix_trie(_conversations(spark, [(1, 1, "a", "b")]).limit(0)).count() == 0
    for rows in ([(None, 1, "a", "b")], [(7, None, None, None)], [(108, 0, "u", "x")], [(100, 0, "u", "x"), (101, 0, "u", "x"), (102, 0, "u", "x")]):
        assert collections.Counter(tuple(r) for r in T.prefix_trie(_conversations(spark, rows)).collect()) == _trie(rows)


@pytest.mark.parametrize("deep", [1, 2, 7, 64, 100])
def test_subtree_sums_of_a_path(spark, deep):
    rows = [(d, 0, d, d - 1 if d else None, 0 if d else None, 1) for d in range(deep)]
    nodes = spark.createDataFrame(rows, "k1 long, k2 long, depth long, p1 long, p2 long, v long")
    assert {r["k1"]: r["v"] for r in T.subtree_sums(nodes, ["v"]).collect()} == {d: deep - d for d in range(deep)}
