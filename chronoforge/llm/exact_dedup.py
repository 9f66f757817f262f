"""Exact deduplication with a two-pass Bloom filter (operator 5), DataFrame functions only.

Pass 1 hashes every text and marks two bits of one 64-bit word of a blocked Bloom filter. Only bits
that at least two rows mark stay set; the filter is a table (word, bits), made by two aggregates of
8-byte keys that fold hot keys before the shuffle. Pass 2 probes every row: a repeated text finds
both its bits, a unique one nearly never. Rows that do not are certainly unique and pass straight
through; only the others are shuffled, grouped by the SHA-256 of the text and joined to their group.

The filter is broadcast only while its counted words are within ``BROADCAST_IDS``; beyond that the
probe is a shuffled join of the narrow digest rows. The join to the groups is an ordinary equi-join
whose two sides are plain exchanges, which AQE splits when a third of all rows is one group.

Edge cases: a null text counts as empty; of equal texts the row with the largest doc_id stays, a
null doc_id being the smallest; rows that repeat both doc_id and text leave exactly one kept row;
an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoforge.llm.common import inputs, scratch, small

#: rows that share one 64-bit word of the filter on average
ROWS_PER_WORD = 4


def _bits(h: Column, words: int) -> tuple[Column, Column, Column]:
    """Word of a hash and its two distinct bits."""
    word = h.bitwiseAND(F.lit(words - 1).cast("long"))
    one = F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(63).cast("long")).cast("int")
    two = ((one + 1 + F.shiftrightunsigned(h, 50) % 63) % 64).cast("int")
    return word, one, two


def _digests(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.sha2(text, 256).alias("text_sha256"), F.xxhash64(text).alias("h"))


def repeated_filter(hashes: DataFrame, n_rows: int) -> tuple[DataFrame, int]:
    """Pass 1: (word, bits) of the bits that two or more rows of ``hashes(h)`` mark."""
    words = 1 << max(4, (n_rows // ROWS_PER_WORD).bit_length())
    word, one, two = _bits(F.col("h"), words)
    marks = hashes.select(word.alias("word"), F.explode(F.array(one, two)).alias("bit"))
    twice = marks.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    bits = F.expr("bit_or(shiftleft(1L, bit))")
    return scratch(twice.groupBy("word").agg(bits.alias("bits"))), words


def mark_repeats(rows: DataFrame, bloom: DataFrame, words: int) -> DataFrame:
    """Pass 2: ``rows`` with the flag ``maybe``: false where h is certainly unique."""
    word, one, two = _bits(F.col("h"), words)
    probed = rows.withColumn("word", word).join(small(bloom, bloom.count()), "word", "left")
    mask = F.expr("shiftleft(1L, __one)").bitwiseOR(F.expr("shiftleft(1L, __two)"))
    return (probed.withColumn("__one", one).withColumn("__two", two)
            .withColumn("maybe", F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False)))
            .drop("word", "bits", "__one", "__two"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of ``docs``."""
    rows = scratch(_digests(inputs(docs, id_col, text_col)))
    bloom, words = repeated_filter(rows, rows.count())
    marked = scratch(mark_repeats(rows, bloom, words).drop("h"))
    unique = marked.where("NOT maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    each = marked.where("maybe").groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("c"))
    groups = scratch(each.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("c").alias("group_size")))
    placed = each.join(groups, "text_sha256").withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "c")))
    repeated = placed.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256")
    return unique.unionByName(repeated)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, that ``exact_dedup`` keeps. Losers are named by (id, digest), so
    that a doc_id with several texts loses only the copied ones."""
    found = scratch(exact_dedup(docs, id_col, text_col).where("group_size > 1"))
    lost = found.where("NOT doc_id <=> keep_id").select(F.col("doc_id").alias("__i"), F.col("text_sha256").alias("__s")).distinct()
    same = scratch(found.where("doc_id <=> keep_id").groupBy(F.col("doc_id").alias("__i"), F.col("text_sha256").alias("__s"))
                   .agg(F.count(F.lit(1)).alias("__c")).where("__c > 1").drop("__c"))
    keyed = docs.withColumn("__k", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    on = F.col(id_col).eqNullSafe(F.col("__i")) & (F.col("__k") == F.col("__s"))
    n = found.count()
    kept = keyed.join(small(lost, n, 200_000), on, "left_anti")
    if same.isEmpty():
        return kept.drop("__k")
    twins = small(same, n, 200_000)
    once = kept.join(twins, on, "left_semi").dropDuplicates([id_col, "__k"])
    return kept.join(twins, on, "left_anti").unionByName(once).drop("__k")
