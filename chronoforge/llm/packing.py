"""Packing of documents into sequences by a configuration linear program (operator 2).

1. Documents become token ids (byte-level BPE of a tokenizers file, then the end id 2). Only longer ones
   are cut, into full sequences; the first piece takes the remainder. Pieces are counted by length.
2. The configuration LP over that histogram (at most ``capacity`` lengths, whatever the input)
   is solved by multiplicative weights: a length's price falls exponentially with its coverage, the
   best configuration at the current prices is an unbounded knapsack dynamic program, and it is raised
   until one of its lengths has gained a step of coverage.
3. The solution is rounded down against the remaining counts, largest share of its value first, and the
   LP is solved again for what is left; the last remainder, a few pieces of each length, is filled greedily,
   largest first. The plan has as many rows as distinct configurations, not as sequences.
4. Every piece gets its rank among those of its length (window over (length, chunk), chunk offsets from
   counts, so the many full pieces are spread over tasks) and finds its place in the plan by search.

Only the histogram and the plan pass through the driver. Edge cases: a null or empty text is the end id
alone; a text that fits exactly fills its sequence; repeated rows are packed each for itself; rows
with a null doc_id are packed too; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoforge.llm import kernels as K
from chronoforge.llm.byte_bpe import encode, forget, text_runs, tokenizer
from chronoforge.llm.common import batch_of, inputs, scratch, small

CAPACITY = 1024
END_ID = 2
#: coverage that one step of the multiplicative weights adds at most, and the steepness of prices
STEP = 0.1
STEEP = 4.0
MAX_STEPS = 400
#: configurations raised for one pricing, and their price against the best
PRICED = 24
NEAR = 0.97
#: unused tokens of a configuration that rounding accepts; emptier ones are left to the next solution
WASTE = 2
#: times that the LP is solved for what rounding left
ROUNDS = 2
#: rows of one rank window on average
CHUNK_ROWS = 50_000

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each piece of each document."""

    def run(batches):
        try:
            yield from pieces(batches, tokenizer(path)[0])
        finally:
            forget(path)
            K.give_back()

    def pieces(batches, cache):
        for b in batches:
            doc = b.column("doc_id").to_pylist()
            for lo, hi, texts in text_runs(b.column("text")):
                ids, first, _ = encode(texts, cache)
                out = {c: [] for c in _PIECES.names}
                for d, a, z in zip(doc[lo:hi], first[:-1].tolist(), first[1:].tolist()):
                    own = np.append(ids[a:z], end_id).astype("<u4")
                    at, piece = 0, 0
                    while at < len(own):
                        n = (len(own) - at) % capacity or capacity
                        for c, v in zip(_PIECES.names, (d, piece, at, n, zlib.crc32(own[at:at + n].tobytes()))):
                            out[c].append(v)
                        at, piece = at + n, piece + 1
                yield batch_of(_PIECES, out)

    return docs.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _best(prices: np.ndarray, capacity: int, many: int) -> list[np.ndarray]:
    """Counts by length of up to ``many`` configurations whose price is within ``NEAR`` of the largest:
    unbounded knapsack by dynamic programming over the capacity, each traced from another first length."""
    value, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    lengths = np.flatnonzero(prices > 0)
    worth = prices[lengths]
    ends = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(int(lengths[0]), capacity + 1):
        n = ends[c]
        v = value[c - lengths[:n]] + worth[:n]
        i = int(v.argmax())
        value[c], choice[c] = (v[i], lengths[i]) if v[i] > value[c - 1] else (value[c - 1], 0)
    total = worth + value[capacity - lengths]
    found = []
    for i in np.argsort(-total, kind="stable")[:many]:
        if total[i] < NEAR * value[capacity]:
            break
        out = np.zeros(capacity + 1, np.int64)
        out[lengths[i]], c = 1, capacity - int(lengths[i])
        while c > 0:
            if choice[c]:
                out[choice[c]] += 1
                c -= int(choice[c])
            else:
                c -= 1
        found.append(out)
    return found


def solve(demand: np.ndarray, capacity: int, max_steps: int = MAX_STEPS) -> list[tuple[np.ndarray, float]]:
    """Configurations and their (fractional) numbers that cover ``demand`` by length, by multiplicative
    weights on the covering constraints."""
    need = demand > 0
    covered = np.zeros(len(demand))
    out: dict[bytes, list] = {}
    for _ in range(max_steps):
        open_ = need & (covered < 1)
        if not open_.any():
            break
        for best in _best(np.where(open_, np.arange(len(demand)) * np.exp(-STEEP * covered), 0.0), capacity, PRICED):
            used = best > 0
            if (covered[used] >= 1 + STEP).any():
                continue
            raised = float((np.maximum(STEP, 1.0 / demand[used]) * demand[used] / best[used]).min())
            covered[used] += raised * best[used] / demand[used]
            entry = out.setdefault(best.tobytes(), [best, 0.0])
            entry[1] += raised
    return [(c, x) for c, x in out.values()]


def _take(left: np.ndarray, config: np.ndarray, most: int) -> int:
    """Use ``config`` up to ``most`` times while pieces are left for it."""
    used = config > 0
    n = min(most, int((left[used] // config[used]).min()))
    left -= n * config
    return n


def pack_histogram(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[np.ndarray, int]]:
    """Configurations (counts by length) and how often each is used; together exactly ``counts``."""
    left, plan = counts.astype(np.int64).copy(), []
    if left[capacity]:  # full pieces are configurations of their own
        full = np.zeros_like(left)
        full[capacity] = 1
        plan.append((full, _take(left, full, int(left[capacity]))))
    for _ in range(ROUNDS):
        lengths = np.arange(len(left))
        for config, x in sorted(solve(left, capacity), key=lambda p: -p[1] * float(p[0] @ lengths)):
            if config @ lengths >= capacity - WASTE and (n := _take(left, config, int(x))):
                plan.append((config, n))
    while left.any():  # greedy: the longest piece left, then the longest that still fits, and so on
        config, room = np.zeros_like(left), capacity
        for length in np.flatnonzero(left)[::-1]:
            n = min(int(left[length]), room // int(length))
            config[length], room = n, room - n * int(length)
        plan.append((config, _take(left, config, int(left.max()))))
    return plan


def place_table(plan: list[tuple[np.ndarray, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, first sequence, copies in a sequence, offset of the first copy."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    reached: dict[int, int] = {}
    sequence = 0
    for config, n in plan:
        at = 0
        for length in np.flatnonzero(config)[::-1].tolist():
            copies = int(config[length])
            rows.setdefault(length, []).append((reached.get(length, 0), sequence, copies, at))
            reached[length] = reached.get(length, 0) + n * copies
            at += length * copies
        sequence += n
    return {length: tuple(np.array(x, np.int64) for x in zip(*r)) for length, r in rows.items()}


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row for each piece."""
    pieces = scratch(token_pieces(inputs(docs, id_col, text_col), path, capacity, end_id))
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most capacity rows
        counts[r["length"]] = r["n"]
    table = docs.sparkSession.sparkContext.broadcast(place_table(pack_histogram(counts, capacity)))

    chunks = max(16, int(counts.sum() // CHUNK_ROWS))
    dealt = pieces.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(chunks)))
    sizes = dealt.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = scratch(sizes.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("chunk")) - F.col("n"))
                     .select(F.col("length").alias("__l"), F.col("chunk").alias("__c"), "base"))
    in_chunk = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("nth", F.row_number().over(in_chunk) - 1).join(
        small(before, before.count()), (F.col("length") == F.col("__l")) & (F.col("chunk") == F.col("__c"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
    out = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def put(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                first, base, copies, at = table.value[int(n)]
                own = length == n
                i = np.searchsorted(first, rank[own], side="right") - 1
                nth = rank[own] - first[i]
                sequence[own], offset[own] = base[i] + nth // copies[i], at[i] + nth % copies[i] * n
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in _PIECES.names), pa.array(sequence), pa.array(offset)], schema=out)

    return ranked.mapInArrow(put, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
