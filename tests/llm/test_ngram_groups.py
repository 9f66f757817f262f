"""Operator 10 on large groups of sets that are alike, some linked and some not: every link of brute force is found, also
those that only the differences to a group's base show."""

import collections

import numpy as np
import pytest

from chronoforge.llm import ngram_join as N


def _shingles(words):
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def _roots(sets):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))]


def _groups(seed: int):
    """Near copies of a text: alike in three fifths and more of their shingles; variants that a part of the group shares; pairs
    that only share a variant; and others that have no more than a passage in common."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(160)]
    texts = []

    def edited(words, n, tag):
        words = list(words)
        for p in rng.choice(len(words), n, replace=False):
            words[p] = f"{tag}x{p}"
        return words

    for i in range(70):
        texts.append(edited(base, int(rng.integers(3, 9)), f"a{i}"))  # mostly too far from each other, near the base
    variant = edited(base, 12, "variant")
    for i in range(40):
        texts.append(edited(variant, int(rng.integers(1, 7)), f"b{i}"))
    for i in range(12):
        far = edited(base, 30, f"far{i}")
        texts += [far, edited(far, 1, f"twin{i}")]  # far from all but its twin
    for i in range(25):
        texts.append([f"own{i}x{j}" for j in range(90)] + base[20:60])
    return texts, base


@pytest.mark.parametrize("rare", [1, 8])
@pytest.mark.parametrize("with_base", [False, True])
def test_groups_of_alike_sets_equal_brute_force(spark, rare, with_base, monkeypatch):
    texts, base = _groups(5)
    if with_base:
        texts.append(base)
    order = np.random.default_rng(1).permutation(len(texts))
    rows = [(int(i) + 1, " ".join(texts[j])) for i, j in enumerate(order)]
    sets = [_shingles(t.split()) for _, t in rows]
    roots = _roots(sets)
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(least.get(r, i), i)
    seen = collections.Counter()
    inner = N._group_links

    def spied(*args):
        out = inner(*args)
        seen["links"] += out.count()
        return out

    monkeypatch.setattr(N, "_group_links", spied)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rare=rare).collect()}
    assert got == {i: (len(s), least[r]) for (i, _), s, r in zip(rows, sets, roots)}
    assert len(set(roots)) > 30  # alike but unlinked sets remain apart
    if not with_base:
        assert seen["links"] > 0


def test_candidates_of_a_group_grow_with_its_size(spark):
    """Owners of one frequent combination, all alike and none linked: the candidates do not grow with pairs."""
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(200)]
    made = []
    for size in (60, 240):
        rows = []
        for i in range(size):
            words = list(base)
            for p in rng.choice(200, 12, replace=False):
                words[p] = f"e{i}x{p}"
            rows.append((i, " ".join(words)))
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        tried = []
        inner = N._links

        def counted(own, pairs, sketches):
            tried.append(pairs.count())
            return inner(own, pairs, sketches)

        N._links = counted
        try:
            N.ngram_join(docs).count()
        finally:
            N._links = inner
        made.append(sum(tried))
    assert made[1] <= 8 * max(made[0], 60)
