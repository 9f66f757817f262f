"""SimHash near-duplicates by pigeonring filtering (operator 12).

A fingerprint's 64 bits form a ring of four segments of 16 bits. Two fingerprints that differ in at most
two bits have half a bit a segment on average, so from some segment on every run of consecutive segments
stays within its proportional budget (the pigeonring principle): none in the first segment, one in the
first two and in the first three, two in all four. The index holds this chain as equality keys: the first
segment and the next 32 bits, of which a single differing bit lies in one of four bytes, so that leaving
out one byte at a time gives four keys for each of the four starts. A fingerprint that shares none of its
sixteen keys with another one has no partner and leaves the job.

The full Hamming check of the others is an equality too: two fingerprints differ in at most two bits if
and only if some 64-bit value, their centre, is at most one bit from both. Each survivor names itself and
its one-bit neighbours in those bits that its shared keys leave open; what meets at a centre is linked
to the least fingerprint there. A centre has 65 possible members at most, so that no bucket, however
dense, is ever expanded into pairs and the output grows in proportion to the distinct fingerprints.

Edge cases: a null or empty text and one without words has the fingerprint zero and is linked like any
other; one or two words are one shingle; rows that repeat a doc_id count as documents of their own; a null
doc_id never is a component's id unless its component has no other; an empty table gives an empty result.
Only the id and text columns are read. Any length of text is hashed in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoforge.llm.common import batch_of, inputs, scratch, small
from chronoforge.llm.components import components
from chronoforge.llm.kernels import text_slices

SEGMENTS, SEGMENT_BITS, MASKED_BITS = 4, 16, 8
#: shingles whose bits are counted at once
COUNT_BLOCK = 1 << 15
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """The signed 64-bit fingerprint: a bit is set if over half of the shingles' XXH64 values set it."""
    words = text.translate(_LOWER).split()  # bytes.split() cuts at exactly \x20 and \x09-\x0D
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = max(len(words) - width + 1, 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends[:n] - [len(w) + 1 for w in words[:n]]).tolist()
    stops = (ends[-n:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, COUNT_BLOCK):
        h = np.array([digest(line[a:b], seed) for a, b in zip(starts[lo:lo + COUNT_BLOCK], stops[lo:lo + COUNT_BLOCK])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of every row of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [fingerprint(t, width, seed) for _, _, texts in text_slices(b.column("text")) for t in texts]
            yield batch_of(_PRINTS, {"doc_id": b.column("doc_id").to_pylist(), "fp": out})

    return docs.mapInArrow(run, "doc_id long, fp long")


def _rotated(fp: Column, start: int) -> Column:
    """The ring with segment ``start`` in the lowest bits."""
    by = SEGMENT_BITS * start
    return fp if not by else F.shiftrightunsigned(fp, by).bitwiseOR(F.shiftleft(fp, 64 - by))


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def _tags() -> list[tuple[int, int]]:
    return [(i, j) for i in range(SEGMENTS) for j in range(2 * SEGMENT_BITS // MASKED_BITS)]


def chain_keys(fp: Column) -> Column:
    """The sixteen keys of a fingerprint: 40 bits of a chain and, above bit 48, which chain it is."""
    keys = []
    for tag, (i, j) in enumerate(_tags()):
        kept = ((1 << 48) - 1) & ~(((1 << MASKED_BITS) - 1) << (SEGMENT_BITS + MASKED_BITS * j))
        keys.append(_rotated(fp, i).bitwiseAND(F.lit(kept).cast("long")).bitwiseOR(F.lit(tag << 48).cast("long")))
    return F.array(*keys)


def open_bits(i: int, j: int) -> list[int]:
    """The bits in which members of a key may differ: the byte left out and the last segment."""
    low = [SEGMENT_BITS + MASKED_BITS * j + b for b in range(MASKED_BITS)] + list(range(3 * SEGMENT_BITS, 64))
    return [(b + SEGMENT_BITS * i) % 64 for b in low]


def links(prints: DataFrame) -> DataFrame:
    """(a, b): a spanning set of links between the distinct fingerprints of ``prints(fp)``. Every pair within
    two bits is connected by it, and no pair beyond is in it but through others."""
    keyed = prints.select("fp", F.explode(chain_keys(F.col("fp"))).alias("key"))
    shared = scratch(keyed.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select("key"))
    met = keyed.join(small(shared, shared.count()), "key", "left_semi")
    opened = [F.lit(sum(_signed(1 << b) for b in open_bits(i, j))).cast("long") for i, j in _tags()]
    tag = F.shiftright("key", 48).cast("int")
    survivors = met.select("fp", F.element_at(F.array(*opened), tag + 1).alias("open")).groupBy("fp").agg(F.bit_or("open").alias("open"))
    bits = F.filter(F.array(*[F.lit(_signed(1 << b)).cast("long") for b in range(64)]), lambda x: F.col("open").bitwiseAND(x) != 0)
    centres = survivors.select("fp", F.explode(F.concat(F.array(F.lit(0).cast("long")), bits)).alias("flip"))
    at = centres.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    # at most 65 distinct fingerprints lie within one bit of a centre
    met_at = at.groupBy("centre").agg(F.collect_list("fp").alias("near")).where(F.size("near") > 1)
    stars = met_at.select(F.array_min("near").alias("b"), F.explode("near").alias("a")).where("a != b")
    return stars.select("a", "b").distinct()


def simhash_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of ``docs``; component_id is the smallest
    doc_id reachable over links of two or fewer differing bits."""
    rows = scratch(fingerprints(inputs(docs, id_col, text_col), width))
    classes = scratch(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    reached = components(links(classes.select("fp")))
    grouped = classes.join(reached.withColumnRenamed("id", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    least = grouped.where("component IS NOT NULL").groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch(grouped.where("component IS NOT NULL").select("fp", "root").join(least, "root").select("fp", "component_id")
                    .unionByName(grouped.where("component IS NULL AND n > 1").select("fp", F.col("least").alias("component_id"))))
    out = rows.join(small(named, named.count()), "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.coalesce("component_id", "doc_id").alias("component_id"))
