"""The bounded labelled sample that the classifiers of this subpackage learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoforge.llm.common import having_ids, inputs, scratch


def held_out(of: int, rest: int):
    """crc32 of the doc_id as text, modulo ``of``, is ``rest``; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == rest, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, of: int, rest: int, most: int, each: bool) -> list[tuple[bytes, int]]:
    """At most ``most`` labelled texts outside the held-out part, chosen by the hash of their doc_id: of each
    class if ``each``, else in all. A doc_id that repeats in the labels has the larger label; one that
    repeats in the documents is left out."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c = 1 AND doc_id IS NOT NULL").drop("c")
    known = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    known = scratch(known.where(~held_out(of, rest)).join(ids, "doc_id"))
    order = F.xxhash64("doc_id", F.lit(17)), F.col("doc_id")
    parts = [known.where(F.col("y") == k).orderBy(*order).limit(most) for k in (0, 1)] if each else [known.orderBy(*order).limit(most)]
    chosen = scratch(parts[0].unionByName(parts[1]) if each else parts[0])
    texts = having_ids(inputs(docs), chosen.select(F.col("doc_id").alias("id"))).join(F.broadcast(chosen), "doc_id")
    rows = texts.orderBy("doc_id").select("text", "y").collect()  # at most 2 * most rows by construction
    return [((r["text"] or "").encode(), r["y"]) for r in rows]
