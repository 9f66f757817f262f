"""N-gram Jaccard self-join by token-combination prefixes (operator 10).

A document's set is its distinct five-word shingles (64-bit hashes; words are lower-cased A-Z).
Documents link when 100 * intersection >= 75 * union.

1. Copies of one set form a class; the smallest doc_id represents it. Partial aggregation folds a
   group of copies before anything is shuffled, so a third of all rows being copies costs nothing.
2. Heavy shingles (in at least ``phi`` of all sets; at most average set size / phi of them, so their
   broadcast is bounded whatever the input) come last in the global order; the rest is by hash.
3. Single tokens: every representative indexes an extended prefix of that order, n - ceil(3n/4) + 1 + s
   tokens with s = n div 8. A token with at most ``rare`` owners yields its pairs. Similar sets share at
   least 1 + min(s, s') of these tokens, so a set with no more than min(s, s') tokens of the frequent
   class (heavy, or more than ``rare`` owners) shares a rare one with every similar set: it is done.
4. Combinations: the other sets index 2-token combinations, the adjacent pairs in the global order.
   Similar sets of union u share at least c = u/2 - 1 of them, since each differing token parts at most
   two adjacent pairs. Their prefix is extended in the same way, by n div 4, and a set with no more
   frequent combinations than that is done. Only the sets that remain (large groups of near copies)
   look at the owners of frequent combinations of the plain prefix: these meet a single pivot first. Combinations
   whose owners then lie in several components are taken up by differences (``_group_links``): their owners form
   groups, a group has a base set (the tokens of most of a few members; any base gives the same links), and a
   member is its difference D to the base. Two members without a common token in their differences are |D| + |D'|
   apart, so if any such pair links, both link with the member nearest to the base: one star. Any other pair with
   a link shares a token of the differences, and a member outside the group's main component finds it by its
   first |D| - o + 1 tokens, rare ones first, o being the least overlap that a link takes; tokens so late in either
   order that less than the overlap is left do not meet.
5. Candidates pass the length bound and a parity sketch (a lower bound of the symmetric difference,
   so it loses nothing), and survivors are verified on the whole sets.
6. Links give components; every copy takes its representative's.

Any pair over the threshold shares a rare token or a rare combination, or both sides remain and share a
frequent combination: no link is lost. Index keys are cut to a bucket and 32 bits within it: a collision
only joins two tokens to one, which adds candidates. A pair whose sides are already connected need not be verified.

Edge cases: null or wordless text has an empty set and links with nothing (component_id = doc_id);
fewer than five words make one shingle of the whole sequence; a null doc_id links with nothing and has
a null component; rows that repeat a doc_id are one vertex, so their sets' links are shared; an
empty table gives an empty result. Only the id and text columns are read, so further columns may
have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoforge.llm import kernels as K
from chronoforge.llm.common import BROADCAST_BYTES, batch_of, having_ids, inputs, scratch, small, table_of
from chronoforge.llm.components import components

WIDTH = 5
#: tokens and combinations with at most so many owners yield their pairs directly
RARE = 8
#: members whose common tokens make a group's base
SAMPLE = 15
#: a shingle in at least this share of the sets is heavy
PHI = 0.0003
#: tokens that a task counts at once
COUNT_TOKENS = 4_000_000
#: index entries that one bucket (one task) holds on average
BUCKET_ENTRIES = 400_000

_SIG = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64())])
_ENTRY = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("blob", pa.binary())])
_PAIR = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("na", pa.int64()), ("nb", pa.int64())])
_ENTRIES, _SKETCH, _FREQUENT = 0, 1, 2
_CANDIDATE, _MEMBER, _COUNT = 0, 1, 2
#: tokens and combinations that a prefix is extended by, as SQL of the least size ``q`` of a similar set
_SLACK_SINGLE, _SLACK_PAIR = "q div 8", "greatest(0, least(q div 4, (q - 1) div 2 - 1))"


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, shingle hashes, offsets) of runs of documents."""
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        for lo, hi, texts in K.text_slices(b.column(1)):
            v, off = K.shingle_sets(texts, WIDTH)
            yield ids[lo:hi].astype(np.int64), v, off


def _signatures(phi: float):
    def run(batches):
        held, filled, docs = np.empty(COUNT_TOKENS, np.uint64), 0, 0

        def heavy():  # a token in phi of all sets is in phi of the sets of at least one run
            nonlocal filled, docs
            v = held[:filled]
            v.sort()
            least = max(2, math.ceil(phi * docs))
            u = np.unique(v[least - 1:][v[least - 1:] == v[:max(len(v) - least + 1, 0)]])  # sorted, equal so far apart
            zero = np.zeros(len(u), np.int64)
            yield batch_of(_SIG, {"kind": zero.astype(np.int32) + 1, "id": u.view(np.int64),
                                  "n": np.searchsorted(v, u, side="right") - np.searchsorted(v, u), "s1": zero, "s2": zero})
            filled = docs = 0

        for ids, v, off in _runs(batches):
            n = np.diff(off)
            with np.errstate(over="ignore"):
                c1 = np.r_[np.uint64(0), np.cumsum(v, dtype=np.uint64)]
                c2 = np.r_[np.uint64(0), np.cumsum(K.mix64(v ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)]
                s1, s2 = c1[off[1:]] - c1[off[:-1]], c2[off[1:]] - c2[off[:-1]]
            zero = np.zeros(len(ids), np.int32)
            yield batch_of(_SIG, {"kind": zero, "id": ids, "n": n, "s1": s1.view(np.int64), "s2": s2.view(np.int64)})
            if filled + len(v) > len(held):
                yield from heavy()
                held = held if len(v) <= len(held) else np.empty(len(v), np.uint64)
            held[filled:filled + len(v)] = v
            filled += len(v)
            docs += len(ids)
        yield from heavy()
        del held
        K.give_back()

    return run


def _parity(s: np.ndarray) -> bytes:
    """Parity of each of B >= 2n hash cells (B a power of two, 256 at least), as bits."""
    bits = max(256, 1 << int(2 * len(s) - 1).bit_length()) if len(s) else 256
    return np.packbits((np.bincount((s >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _apart(p: bytes, q: bytes) -> int:
    """At most the size of the symmetric difference of the sketched sets."""
    x, y = np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _blobs(tokens, owner, base, ids, sizes, buckets: int, rare: int):
    """Index entries (32-bit key, 2 * row of owner + base) packed by bucket, then the run's hot entries
    (key with its bucket, owner, base). A key with more than ``rare`` owners in this run is frequent for
    certain: its owners are reported at once and only the key travels."""
    b = np.uint64(buckets)
    keys = ((tokens % b) << np.uint64(32)) | ((tokens // b) & np.uint64(0xFFFFFFFF))
    order = np.argsort(keys, kind="stable")
    keys, owner, base = keys[order], owner[order], base[order]
    edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    count = np.diff(np.r_[edge, len(keys)])
    hot = np.repeat(count > rare, count)
    hot_keys = keys[edge[count > rare]]
    cold, of, flag = keys[~hot], owner[~hot], base[~hot]
    present = np.unique(np.r_[cold, hot_keys] >> np.uint64(32))
    low, low_hot = cold.astype(np.uint32), hot_keys.astype(np.uint32)
    cuts, cuts_hot = (np.searchsorted(k, np.r_[present, b] << np.uint64(32)) for k in (cold, hot_keys))
    out = []
    for j, bucket in enumerate(present.tolist()):
        lo, hi = cuts[j], cuts[j + 1]
        rows, ref = np.unique(of[lo:hi], return_inverse=True)
        ref = (2 * ref + flag[lo:hi]).astype(np.uint16 if len(rows) <= 32768 else np.uint32)
        out.append((bucket, K.pack(low[lo:hi], ref, ids[rows], sizes[rows].astype(np.uint32),
                                   low_hot[cuts_hot[j]:cuts_hot[j + 1]], np.array([ref.itemsize], np.uint8))))
    return out, (keys[hot], owner[hot], base[hot])


def _index(order_of, prefix_of, buckets: int, rare: int, sketch: bool, members: bool):
    """Map side of both indexes. prefix_of(set in the global order, size) -> (tokens of the extended
    prefix, how many of them are of the plain one, frequent tokens of it that are not indexed)."""

    def run(batches):
        for ids, v, off in _runs(batches):
            n = np.diff(off)
            keys, owner, base, prints = [], [], [], []
            frequent = np.zeros(len(ids), np.int64)
            for d in range(len(ids)):
                if not n[d]:
                    continue
                s = v[off[d]:off[d + 1]]
                if sketch:
                    prints.append((ids[d], n[d], _parity(s)))
                got, plain, frequent[d] = prefix_of(order_of(s), len(s))
                keys.append(got)
                owner.append(np.full(len(got), d, np.int64))
                base.append(np.arange(len(got)) < plain)
            keys = np.concatenate(keys) if keys else v[:0]
            owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
            base = np.concatenate(base) if base else np.zeros(0, bool)
            blobs, (hot, of, flag) = _blobs(keys, owner, base, ids, n, buckets, rare)
            rows = [(_ENTRIES, bucket, 0, 0, blob) for bucket, blob in blobs]
            if members:  # owners of a combination that is frequent in this run
                rows += [(_MEMBER + 10, int(k), int(ids[d]), int(n[d]), b"") for d, k in zip(of[flag], hot[flag].view(np.int64))]
            frequent += np.bincount(of, minlength=len(ids))
            rows += [(_FREQUENT, int(frequent[d]), int(ids[d]), int(n[d]), b"") for d in np.flatnonzero(frequent)]
            rows += [(_SKETCH, 0, int(i), int(m), p) for i, m, p in prints]
            if rows:
                yield batch_of(_ENTRY, dict(zip(_ENTRY.names, zip(*rows), strict=True)))
        K.give_back()

    return run


def _pairs_of(keys, ids, n, base, rare, known):
    """Distinct pairs within runs of one key of 2 to ``rare`` owners, by the length bound, and the entries
    (key, id, size, base) of keys that have more or are ``known`` to be frequent."""
    out = []
    o = np.lexsort((~base, ids, keys))
    keys, ids, n, base = keys[o], ids[o], n[o], base[o]
    same = np.r_[False, (keys[1:] == keys[:-1]) & (ids[1:] == ids[:-1])] if len(keys) else np.zeros(0, bool)
    keys, ids, n, base = keys[~same], ids[~same], n[~same], base[~same]
    edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    count = np.diff(np.r_[edge, len(keys)])
    frequent = (count > rare) | np.isin(keys[edge], known)
    for m in np.unique(count[(count >= 2) & ~frequent]):
        at = edge[(count == m) & ~frequent][:, None] + np.arange(m)
        g = np.unique(np.concatenate([ids[at], n[at]], axis=1), axis=0)
        i, j = np.triu_indices(m, 1)
        p = np.stack([g[:, i].ravel(), g[:, j].ravel(), g[:, m + i].ravel(), g[:, m + j].ravel()], axis=1)
        lo, hi = np.minimum(p[:, 2], p[:, 3]), np.maximum(p[:, 2], p[:, 3])
        out.append(p[4 * lo >= 3 * hi])
    big = np.repeat(frequent, count)
    pairs = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 4), np.int64)
    return pairs, keys[big], ids[big], n[big], base[big]


def _bucket(rare: int, members: bool):
    """Reduce side: the pairs of rare keys, the number of frequent keys of each owner (and its size, ``na``),
    and with ``members`` the owners of the frequent keys of plain prefixes."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys, ids, n, base, hot = [], [], [], [], []
        for blob in table.column("blob").to_pylist():
            k, ref, i, m, h, w = K.unpack(blob, np.uint32, np.uint8, np.int64, np.uint32, np.uint32, np.uint8)
            ref = ref.view(np.uint16 if w[0] == 2 else np.uint32)
            row = ref >> 1
            keys.append(k), ids.append(i[row]), n.append(m[row].astype(np.int64)), base.append((ref & 1).astype(bool)), hot.append(h)
        pairs, fk, fi, fn, fb = _pairs_of(*map(np.concatenate, (keys, ids, n, base)), rare, np.unique(np.concatenate(hot)))
        ci, at, many = np.unique(fi, return_index=True, return_counts=True)
        cn = fn[at]
        fk = fk[fb].astype(np.int64) + (key[0].as_py() << 32) if members else fk[:0].astype(np.int64)
        fi, fn = (fi[fb], fn[fb]) if members else (fi[:0], fn[:0])
        K.give_back()
        kinds = [np.full(len(x), k, np.int32) for x, k in ((pairs, _CANDIDATE), (fi, _MEMBER), (ci, _COUNT))]
        return table_of(_PAIR, {
            "kind": np.concatenate(kinds), "a": np.r_[pairs[:, 0], fk, ci], "b": np.r_[pairs[:, 1], fi, many],
            "na": np.r_[pairs[:, 2], np.zeros(len(fi), np.int64), cn], "nb": np.r_[pairs[:, 3], fn, cn]})

    return run


def _open(index: DataFrame, found: DataFrame, slack: str) -> DataFrame:
    """(id) of the sets that own more frequent keys than the extension of any similar set's prefix."""
    counts = index.where(f"kind = {_FREQUENT}").select("id", "n", F.col("bucket").alias("many")).unionByName(
        found.where(f"kind = {_COUNT}").select(F.col("a").alias("id"), F.col("na").alias("n"), F.col("b").alias("many")))
    return counts.groupBy("id").agg(F.sum("many").alias("many"), F.min("n").alias("n")).withColumn(
        "q", F.expr("(3 * n + 3) div 4")).where(f"many > {slack}").select("id")


def _survivors(batches):
    """Candidates whose sketches allow the threshold."""
    for b in batches:
        c = {k: b.column(k) for k in b.schema.names}
        na, nb = c["na"].to_numpy(), c["nb"].to_numpy()
        need = -(-3 * (na + nb) // 7)
        p, q = c["pa"].to_pylist(), c["pb"].to_pylist()
        ok = np.fromiter((_apart(x, y) for x, y in zip(p, q)), np.int64, len(p)) <= na + nb - 2 * need
        yield pa.RecordBatch.from_arrays([c["a"].filter(pa.array(ok)), c["b"].filter(pa.array(ok))], names=["a", "b"])


def _verified(batches):
    for b in batches:
        keep = []
        for x, y in zip(b.column("sa"), b.column("sb")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            at = np.searchsorted(x, y)
            both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
            keep.append(7 * both >= 3 * (len(x) + len(y)))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])


def _sets(batches):
    schema = pa.schema([("id", pa.int64()), ("s", pa.binary())])
    for ids, v, off in _runs(batches):
        yield batch_of(schema, {"id": ids, "s": [v[off[d]:off[d + 1]].tobytes() for d in range(len(ids))]})


def _links(docs: DataFrame, pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Verified links among candidate ``pairs(a, b)``; sketches(id, n, blob)."""
    one = sketches.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("blob").alias("pa"))
    two = sketches.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("blob").alias("pb"))
    tried = scratch(pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "pa", "pb")
                    .mapInArrow(_survivors, "a long, b long"))
    ids = scratch(tried.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    sets = scratch(having_ids(docs, ids).mapInArrow(_sets, "id long, s binary"))
    left, right = (sets.select(F.col("id").alias(k), F.col("s").alias(f"s{k}")) for k in "ab")
    return tried.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(_verified, "a long, b long")


_BASE = pa.schema([("g", pa.int64()), ("base", pa.binary()), ("seen", pa.binary()), ("times", pa.binary())])
_DELTA = pa.schema([("g", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("c", pa.int64()), ("a", pa.int64()), ("delta", pa.binary())])
_TOKEN = pa.schema([("g", pa.int64()), ("token", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("c", pa.int64()), ("v", pa.int64()), ("rest", pa.int64())])


def _base_of(key: tuple, table: pa.Table) -> pa.Table:
    """Tokens of more than half of a group's sample, and how often each token of the sample occurs."""
    sets = [np.frombuffer(s, np.uint64) for s in table.column("s").to_pylist()]  # SAMPLE of them
    seen, times = np.unique(np.concatenate(sets), return_counts=True)
    return table_of(_BASE, {"g": [key[0].as_py()], "base": [seen[2 * times > len(sets)].tobytes()], "seen": [seen.tobytes()], "times": [times.astype("<i4").tobytes()]})


def _difference(s: bytes, base: bytes, seen: bytes, times: bytes) -> np.ndarray:
    """A set's difference to the base: first its own tokens, those that the sample has least often first, then the
    base's missing ones."""
    x, base, seen, times = np.frombuffer(s, np.uint64), np.frombuffer(base, np.uint64), np.frombuffer(seen, np.uint64), np.frombuffer(times, "<i4")
    own, missing = np.setdiff1d(x, base, assume_unique=True), np.setdiff1d(base, x, assume_unique=True)
    at = np.minimum(np.searchsorted(seen, own), max(len(seen) - 1, 0))
    known = np.where(seen[at] == own, times[at], 0) if len(seen) else np.zeros(len(own), np.int64)
    return np.concatenate([own[np.argsort(known, kind="stable")], missing])


def _deltas(bases):
    """Differences of ``(g, id, c, s)`` to their group's base, looked up in ``bases`` or, if None, in the row's own columns."""
    def run(batches):
        for b in batches:
            columns = ("g", "id", "c", "s") if bases else ("g", "id", "c", "s", "base", "seen", "times")
            for lo in range(0, b.num_rows, 256):
                rows = []
                for g, i, c, s, *base in zip(*(b.column(k).slice(lo, 256).to_pylist() for k in columns)):
                    delta = _difference(s, *(bases.value[g] if bases else base))
                    rows.append((g, i, len(s) // 8, c, len(delta), delta.tobytes()))
                yield batch_of(_DELTA, dict(zip(_DELTA.names, zip(*rows), strict=True)))
    return run


def _tokens(batches):
    """The first ``take`` tokens of each difference, one a row, with the tokens from there on (``rest``)."""
    for whole in batches:
        for b in (whole.slice(lo, 512) for lo in range(0, whole.num_rows, 512)):
            take, a = b.column("take").to_numpy(), b.column("a").to_numpy()
            d = [np.frombuffer(x, np.int64)[:t] for x, t in zip(b.column("delta").to_pylist(), take)]
            size = np.array([len(x) for x in d], np.int64)
            rest = np.repeat(a, size) - np.concatenate([np.arange(k) for k in size])
            yield batch_of(_TOKEN, {"token": np.concatenate(d), "rest": rest.astype(np.int64),
                                    **{k: np.repeat(b.column(k).to_numpy(), size) for k in ("g", "id", "n", "c", "v")}})


def _group_links(own: DataFrame, members: DataFrame, links: DataFrame, sketches: DataFrame) -> DataFrame:
    """Further links among the owners of frequent combinations, ``members(key, id, n)``: with them, every linked pair
    that shares a combination is in one component."""
    similar = "4 * least(n, on) >= 3 * greatest(n, on)"
    placed = members.join(components(links), "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("c"))
    opened = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min(F.struct(F.xxhash64("id").alias("h"), "id")).alias("p")).where("lo < hi")
    groups = scratch(placed.join(opened.select("key", F.col("p.id").alias("g")), "key").select("g", "id", "c").distinct())
    if groups.isEmpty():
        return links.limit(0)
    sets = scratch(having_ids(own, scratch(groups.select("id").distinct())).mapInArrow(_sets, "id long, s binary"))
    sample = groups.groupBy("g").agg(F.array(*[F.min(F.struct(F.xxhash64("id", F.lit(i)).alias("h"), "id")) for i in range(SAMPLE)]).alias("p"))
    sample = sample.select("g", F.explode(F.array_distinct(F.transform("p", lambda x: x["id"]))).alias("id"))
    base = scratch(sample.join(sets, "id").groupBy("g").applyInArrow(_base_of, _ddl(_BASE)))
    size = base.agg(F.sum(F.length("base") + F.length("seen") + F.length("times"))).first()[0] or 0
    bases, met = None, groups.join(sets, "id")
    if size <= BROADCAST_BYTES:  # counted above
        bases = own.sparkSession.sparkContext.broadcast({r["g"]: (bytes(r["base"]), bytes(r["seen"]), bytes(r["times"])) for r in base.collect()})
    else:
        met = met.join(base, "g")
    deltas = scratch(met.mapInArrow(_deltas(bases), _ddl(_DELTA)))
    nearest = scratch(deltas.groupBy("g").agg(F.min(F.struct((7 * F.col("a") - F.col("n")).alias("s"), "id", "n", "c")).alias("p"))
                      .select("g", F.col("p.s").alias("s"), F.col("p.id").alias("oid"), F.col("p.n").alias("on"), F.col("p.c").alias("oc")))
    n_groups = nearest.count()
    star = deltas.join(small(nearest, n_groups), "g").where("c != oc AND " + similar)
    pair = [F.least("id", "oid").alias("a"), F.greatest("id", "oid").alias("b")]
    found = scratch(_links(own, star.select(*pair).distinct(), sketches))

    at = components(links.unionByName(found))
    now = scratch(deltas.drop("c").join(at, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component"))
    main = now.groupBy("g", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("g").agg(F.max(F.struct("k", "c")).alias("m"), F.count(F.lit(1)).alias("parts"))
    main = scratch(main.where("parts > 1").select("g", F.col("m.c").alias("main")).join(nearest.select("g", "s"), "g"))
    still = now.join(small(main, n_groups), "g").withColumn("v", 7 * F.col("a") - F.col("n"))
    overlap = F.greatest(F.lit(1), F.ceil((7 * F.col("a") - F.col("n") + F.col("s")) / 14))
    # a difference of fewer tokens than the overlap that a link takes has none
    outside = still.where("c != main").withColumn("take", F.greatest(F.col("a") - overlap + 1, F.lit(0)).cast("long"))
    parts = "g", "id", "n", "c", "v", "a", "take", "delta"
    asked = scratch(outside.select(*parts).mapInArrow(_tokens, _ddl(_TOKEN)))
    keys = scratch(asked.select("g", "token").distinct())
    every = still.withColumn("take", F.col("a")).select(*parts).mapInArrow(_tokens, _ddl(_TOKEN))
    others = every.join(small(keys, keys.count()), ["g", "token"], "left_semi").select(
        "g", "token", F.col("id").alias("oid"), F.col("n").alias("on"), F.col("c").alias("oc"), F.col("v").alias("ov"), F.col("rest").alias("orest"))
    # the first token that two differences share leaves room for the overlap that their link takes, on both sides
    more = asked.join(others, ["g", "token"]).where("c != oc AND 14 * least(rest, orest) >= v + ov AND " + similar).select(*pair).distinct()
    return found.unionByName(_links(own, more, sketches))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE, phi: float = PHI) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs``."""
    docs = inputs(docs, id_col, text_col)
    seen = scratch(docs.where("doc_id IS NOT NULL").mapInArrow(_signatures(phi), _ddl(_SIG)))
    sig = seen.where("kind = 0").drop("kind")
    n_docs, n_tokens = sig.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    classes = scratch(sig.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")))
    in_class = sig.join(classes.where("size > 1").drop("size"), ["n", "s1", "s2"], "left").select(
        "id", "n", F.coalesce("rep", "id").alias("rep"))
    copies = scratch(in_class.where("id != rep").select("id"))
    own = having_ids(docs.where("doc_id IS NOT NULL"), copies, "left_anti")

    # at most average set size / (phi / 2) shingles reach phi / 2 of the sets: a bounded broadcast
    heavy = [r[0] for r in seen.where("kind = 1").groupBy("id").agg(F.sum("n").alias("c"))
             .where(F.col("c") >= max(2.0, phi * n_docs / 2)).select("id").collect()]
    heavy = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(heavy, np.int64).view(np.uint64)))

    def order_of(s):
        h = heavy.value
        if not len(h):
            return s, len(s)
        at = h[np.minimum(np.searchsorted(h, s), len(h) - 1)] == s
        return np.concatenate([s[~at], s[at]]), len(s) - int(at.sum())

    def singles(ordered, n):
        s, light = ordered
        plain = n - -(-3 * n // 4) + 1
        p = plain + n // 8
        return s[:min(p, light)], plain, max(0, p - light)  # heavy tokens are frequent for certain: not indexed

    def combinations(ordered, n):
        s, _ = ordered
        if n < 3:  # a similar, different set needs three tokens
            return s[:0], 0, 0
        k = K.constants(2, 11)
        with np.errstate(over="ignore"):
            c = K.mix64(s[:-1] * k[0] + s[1:] * k[1])
        c.sort()
        shared = (n - 1) // 2
        plain = n - shared
        return c[:plain + max(0, min(n // 4, shared - 1))], plain, 0

    buckets = max(24, int(n_tokens * 0.39 / BUCKET_ENTRIES))
    index = scratch(own.mapInArrow(_index(order_of, singles, buckets, rare, True, False), _ddl(_ENTRY)))
    sketches = index.where(f"kind = {_SKETCH}").select("id", "n", "blob")
    found = scratch(index.where(f"kind = {_ENTRIES}").select("bucket", "blob").groupBy("bucket")
                    .applyInArrow(_bucket(rare, False), _ddl(_PAIR)))
    frequent = scratch(_open(index, found, _SLACK_SINGLE))

    combined = scratch(having_ids(own, frequent).mapInArrow(_index(order_of, combinations, buckets, rare, False, True), _ddl(_ENTRY)))
    grouped = scratch(combined.where(f"kind = {_ENTRIES}").select("bucket", "blob").groupBy("bucket")
                      .applyInArrow(_bucket(rare, True), _ddl(_PAIR)))
    remaining = scratch(_open(combined, grouped, _SLACK_PAIR))
    owners = grouped.where(f"kind = {_MEMBER}").select(F.col("a").alias("key"), F.col("b").alias("id"), F.col("nb").alias("n")).unionByName(
        combined.where(f"kind = {_MEMBER + 10}").select(F.col("bucket").alias("key"), "id", "n"))
    members = scratch(owners.join(small(remaining, remaining.count()), "id", "left_semi"))
    pivots = members.groupBy("key").agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id", "n")).alias("p")).select(
        "key", F.col("p.id").alias("pid"), F.col("p.n").alias("pn"))
    star = members.join(pivots, "key").where("id != pid AND 4 * least(n, pn) >= 3 * greatest(n, pn)").select(
        F.least("id", "pid").alias("a"), F.greatest("id", "pid").alias("b"))
    pairs = found.unionByName(grouped).where(f"kind = {_CANDIDATE}").select("a", "b").unionByName(star).distinct()
    links = scratch(_links(own, pairs, sketches))

    links = scratch(links.unionByName(_group_links(own, members, links, sketches)))

    rows = scratch(in_class)
    again = rows.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a != b").select("a", "b")
    ends = components(links.unionByName(again))
    linked = rows.join(small(ends, ends.count()), rows["rep"] == ends["id"], "left").select(
        rows["id"].alias("doc_id"), rows["n"].alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    nameless = docs.where("doc_id IS NULL").mapInArrow(_signatures(2.0), _ddl(_SIG)).where("kind = 0").select(
        F.lit(None).cast("long").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return linked.unionByName(nameless)
