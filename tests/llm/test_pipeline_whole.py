"""The whole pipeline, through ``run``, against plain Python versions of its five stages."""

import collections
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as P


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def _line(text):
    return re.sub(r"[\x20\x09\x0B-\x0D]+", " ", text.lower()).strip(" ")


def _quality(rows):
    """Quality rules with common lines removed from all but their first text of a host."""
    hosts = collections.defaultdict(dict)
    for r in rows:
        hosts[r["source"]].setdefault(r["text"] or "", []).append(r["doc_id"])
    common = {}
    for host, texts in hosts.items():
        seen = collections.defaultdict(set)
        for t in texts:
            for x in {_line(x) for x in t.split("\n")} - {""}:
                seen[x].add(t)
        common[host] = {x: s for x, s in seen.items() if len(s) > 10 and len(s) > 0.05 * len(texts)}
    out = []
    for r in rows:
        t, host = r["text"] or "", r["source"]
        w = _words(t)
        grams = collections.defaultdict(list)
        for i in range(len(w) - 2):
            grams[tuple(w[i:i + 3])].append(i)
        repeat = {j for at in grams.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
        if len(w) < 50 or 100 * len(repeat) > 50 * len(w):
            continue
        carrier = {x: min((min((i for i in hosts[host][s]), default=None), s) for s in texts) for x, texts in common[host].items()}
        lines = t.split("\n")
        gone = [x for x in lines if _line(x) in common[host] and carrier[_line(x)][1] != t]
        if sum(len(_line(x).split(" ")) for x in gone) > 0.5 * len(w):
            continue
        out.append({**r, "text": "\n".join(x for x in lines if x not in gone) if gone else r["text"]})
    return out


def _exact(rows):
    last = {}
    for r in rows:
        k = r["text"] or ""
        if k not in last or r["doc_id"] > last[k]["doc_id"]:
            last[k] = r
    return list(last.values())


def _near(rows):
    sets = []
    for r in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in _words(r["text"] or "")]
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    root = {r["doc_id"]: r["doc_id"] for r in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                a, b = sorted((find(rows[i]["doc_id"]), find(rows[j]["doc_id"])))
                root[b] = a
    return [r for r in rows if find(r["doc_id"]) == r["doc_id"]]


def _passages(rows):
    first = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        b = (r["text"] or "").encode()
        for i in range(len(b) - 49):
            first.setdefault(b[i:i + 50], r["doc_id"])
    out = []
    for r in rows:
        b = (r["text"] or "").encode()
        keep = np.ones(len(b), bool)
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < r["doc_id"]:
                keep[i:i + 50] = False
        out.append({**r, "text": bytes(x for x, k in zip(b, keep) if k).decode("utf-8", "ignore")})
    return out


def _rows():
    rng = np.random.default_rng(4)

    def prose(n, tag=""):
        return " ".join(f"w{int(i)}{tag}" + (".\n" if k % 9 == 8 else "") for k, i in enumerate(rng.integers(0, 4000, n)))

    clean = prose(120)
    passage = " ".join(f"passage{i}" for i in range(60))
    texts = [(1, clean)]
    for i in range(40):  # a large group of near copies in one source, every line but one unchanged
        lines = clean.split("\n")
        k = int(rng.integers(0, len(lines)))
        lines[k] = lines[k].replace(" ", f" n{i} ", 1)
        texts.append((10 + i, "\n".join(lines)))
    texts += [(100 + i, prose(80) + "\nmenu home about contact\n" + prose(20)) for i in range(15)]  # a common line
    texts += [(200 + i, prose(70) + " " + passage + " " + prose(30)) for i in range(4)]
    copied = prose(90)
    texts += [(300, copied), (301, copied), (302, copied), (310, "too short"), (311, "again and " * 60), (312, None), (313, ""), (314, prose(60) + " é 🙂")]
    return [{"doc_id": i, "text": t, "lang": "en", "source": "a" if i % 3 or i == 12 else "b", "n_chars": None if t is None else len(t)} for i, t in texts]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_run_equals_the_plain_pipeline(spark, tmp_path):
    rows = _rows()
    spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    stages = [_quality, _exact, _near, _passages]
    states = [rows]
    for f in stages:
        states.append(f(states[-1]))
    docs = P.read_documents(spark, str(tmp_path))
    for k, (name, stage) in enumerate(P.STAGES[:4]):
        path = str(tmp_path / f"stage{k}")
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        got = {(r["doc_id"], r["text"] or "", r["n_chars"] or 0) for r in docs.collect()}
        assert docs.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
        assert got == {(r["doc_id"], r["text"] or "", len(r["text"] or "")) for r in states[k + 1]}, name
    kept = {r["doc_id"] for r in states[3]}
    assert 1 in kept and not kept & set(range(10, 50))  # of the group of near copies the first one is left
    # packing: pieces of the remaining texts by the tokenizers library, in sequences without gaps
    pieces = P.run(spark, str(tmp_path)).collect()
    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in states[4]}
    lengths = collections.defaultdict(int)
    for r in pieces:
        ids = np.array(want[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
        import zlib
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {i: len(x) for i, x in want.items()}
    places = collections.defaultdict(list)
    for r in pieces:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for at in places.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= 1024


def test_stages_take_empty_tables_and_tables_without_length(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        assert stage(spark, empty, "").count() == 0
    rows = [(r["doc_id"] if r["doc_id"] != 302 else None, r["text"], "x") for r in _rows() if r["doc_id"] in (1, 100, 101, 300, 301, 302, 312)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for k, (_, stage) in enumerate(P.STAGES[:4]):
        path = str(tmp_path / f"s{k}")
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == ["doc_id", "text", "source"]
    assert {1, 100, 101} <= {r["doc_id"] for r in docs.collect()}


def test_texts_are_encoded_in_small_runs():
    """Arrays of a run take many times its bytes: a worker holds them for a megabyte of texts or one longer text."""
    import pyarrow as pa

    from chronoforge.llm import byte_bpe as bb

    texts = ["ab cd " * 50_000, None, *["ef gh, " * 20_000] * 20, "ij " * 600_000]
    runs = list(bb.text_runs(pa.array(texts)))
    assert [r[:2] for r in runs][0][0] == 0 and runs[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(runs, runs[1:]))
    assert [t for r in runs for t in r[2]] == [t or "" for t in texts]
    assert all(sum(map(len, r[2])) <= 1 << 20 or len(r[2]) == 1 for r in runs)
