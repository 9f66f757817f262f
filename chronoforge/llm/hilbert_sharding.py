"""Sharding along a Hilbert curve (operator 4).

Metadata dimensions are quantised to ``BITS`` bits each: language and source by their rank among the
distinct values of the column (a hash cell beyond 2^BITS of them), text length by its logarithm. Rows are
range-sorted by (curve index, crc32, doc_id) and runs of equal row counts are cut, so a shard covers
a compact box of all dimensions and files prune on each. The law is ``rows``: counts differ by one at most.

The sort key ends with the text's checksum and the doc_id, so a source with a third of all rows or
thousands of copies of one text is still split between tasks. Ranks come from rows per partition of a
written table, not from a window over everything. Columns are carried, the text is not.

Edge cases: null language or source is a value of its own; null text has size 1 and the checksum of no
bytes; repeated rows take neighbouring slots; a null doc_id is carried; an empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoforge.llm.common import scratch, small
from chronoforge.session import checkpoint_dir

SHARDS = 16
BITS = 6


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points cells[dimension, n] (Skilling's transposition, by columns)."""
    x = cells.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess rotations from the highest bit down
        low = q - 1
        for i in range(n):
            on = (x[i] & q) > 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = np.where(on, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _cells(rows: DataFrame, column: str, bits: int) -> DataFrame:
    """(value, cell): rank of each distinct value, spread over the cells; a hash beyond as many values."""
    values = scratch(rows.select(F.col(column).alias("__v")).distinct())
    n = values.count()
    if n > 1 << bits:
        return values.withColumn("__cell", F.pmod(F.xxhash64("__v"), F.lit(1 << bits)))
    return values.withColumn("__cell", ((F.row_number().over(Window.orderBy("__v")) - 1) * F.lit((1 << bits) // max(n, 1))).cast("long"))


def hilbert_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text",
                   dimensions: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, curve), one row for each row of ``docs``."""
    checkpoint_dir(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = scratch(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), *(F.col(c).cast("string").alias(f"d{i}") for i, c in enumerate(dimensions))))
    placed = rows
    for i in range(len(dimensions)):
        cells = scratch(_cells(rows, f"d{i}", bits)).withColumnRenamed("__cell", f"c{i}")
        placed = placed.join(small(cells, cells.count()), F.col(f"d{i}").eqNullSafe(F.col("__v")), "left").drop("__v", f"d{i}")
    names = [f"c{i}" for i in range(len(dimensions))]
    top = (1 << bits) - 1

    @F.pandas_udf("long")
    def curve(*c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([x.to_numpy(np.int64) for x in c]), bits))

    size_cell = F.least(F.lit(top), (F.log2("size") * F.lit((top + 1) / 32)).cast("long")).cast("long")
    indexed = scratch(placed.select("doc_id", "size", "text_crc32", curve(*names, size_cell).alias("curve")))
    order = ["curve", "text_crc32", "doc_id"]
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = indexed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = scratch(ranged.withColumn("__m", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("__p", F.shiftright("__m", 33)).withColumn("__i", F.col("__m").bitwiseAND(F.lit((1 << 33) - 1)))
    # as many rows as partitions
    sizes = numbered.groupBy("__p").agg(F.count(F.lit(1)).alias("n"))
    base = scratch(sizes.select(F.col("__p").alias("__q"), (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("base"), "n"))
    total = base.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rank = F.col("base") + F.col("__i")
    small_shard, larger = total // shards, total % shards  # the first ``larger`` shards have one row more
    edge = F.lit(larger * (small_shard + 1))
    shard = F.when(rank < edge, F.floor(rank / F.lit(small_shard + 1))).otherwise(
        F.lit(larger) + F.floor((rank - edge) / F.lit(max(small_shard, 1)))).cast("int")
    start = F.when(F.col("shard") <= larger, F.col("shard") * F.lit(small_shard + 1)).otherwise(
        edge + (F.col("shard") - F.lit(larger)) * F.lit(small_shard))
    out = numbered.join(small(base.drop("n"), base.count()), F.col("__p") == F.col("__q")).withColumn("rank", rank).withColumn("shard", shard)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      (F.col("rank") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")
