"""Quality rules with cross-document line frequency (operator 7), DataFrame functions only.

Base rules look at one text. The method looks at the corpus: normalised lines (lower case, white
space runs folded, trimmed) are hashed, the distinct documents of each (host, line) are counted, and a
line in more than ``max_share`` of the host's distinct documents, and in more than ``min_docs``, is
boilerplate. It is removed from every document of the host, and a document that loses more than
``max_lost`` of its words that way is rejected as depleted. Copies of one text count as one document,
so a page is not boilerplate because it was crawled often. ``quality_rules`` gives counts and verdicts,
``clean_texts`` the documents that are kept, without these lines.

Near copies are distinct texts, so in a large group of them every member's lines are above the limits and every
member is depleted. With ``keep_first`` one text of each common line keeps it, the one with the smallest doc_id
among those that pass the base rules: the group's first member stays, the others go. The query follows its SQL twin, where
no text keeps such a line; the pipeline, whose near-duplicate stage comes later, keeps the first.

The host is the ``source`` column (null is a host of its own). The counts fold (host, line, text)
before they shuffle, a hot line is one partial count per task, and the table of lines above the limit
is broadcast only within a counted bound; beyond it the join shuffles and AQE splits a hot line.

Edge cases: null text has no words, fails the base rules and is not kept; repeated rows each get the
same row; an empty table gives an empty result; a null doc_id is carried. Only the id, text and host
columns are read. Three-word windows and lines are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoforge.llm.common import scratch, small

#: fixed values of the base rules
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

MAX_SHARE = 0.05
MIN_DOCS = 10
MAX_LOST = 0.5
#: rows of rejected or changed documents that are broadcast
CHANGED = 500_000


def base_stats(docs: DataFrame) -> DataFrame:
    """Base counts of ``docs(doc_id, text, host, t)``; arrays are columns of their own, so that no
    lambda evaluates them again."""
    text = F.coalesce("text", F.lit(""))
    flat = F.col("text")
    d = docs.withColumn("text", text).withColumn(
        "words", F.filter(F.split(flat, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    d = d.select(
        "doc_id", "host", "t",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(flat, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(flat) - F.length(F.translate(flat, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(flat, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0).alias("lines"),
        F.when(F.size("words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))).alias("windows"))
    d = d.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    # windows found twice or more, as (hash, place) in hash order: equal hashes are neighbours
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    d = d.withColumn("sorted", F.when(some, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("windows")
    d = d.withColumn("places", F.sort_array(F.transform(F.filter(
        "sorted", lambda x, k: (x["h"] == F.get("sorted", k + 1)["h"]).eqNullSafe(True) | (x["h"] == F.get("sorted", k - 1)["h"]).eqNullSafe(True)),
        lambda x: x["i"]))).drop("sorted")
    # each repeated window covers three words, less what the next one covers again
    covered = F.aggregate(
        F.transform("places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("places", k + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("places")
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, host, t, place, line, words) of each line that has a word."""
    flat = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"[\x20\x09\x0B-\x0D]+", " ")
    return (docs.select("doc_id", "host", "t", F.posexplode(F.split(flat, "\n")).alias("place", "row"))
            .withColumn("row", F.trim("row")).where("row != ''")
            .select("doc_id", "host", "t", "place", F.xxhash64("row").alias("line"),
                    (F.length("row") - F.length(F.translate("row", " ", "")) + 1).alias("words")))


def common_lines(docs: DataFrame, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS) -> DataFrame:
    """(host, line) in more than the limit of the host's distinct documents."""
    seen = _lines(docs).select("host", "line", "t").distinct()
    counts = seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > min_docs)
    hosts = scratch(docs.select("host", "t").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("docs")))
    hosts = hosts.withColumnRenamed("host", "__host")
    return scratch(counts.join(small(hosts, hosts.count()), F.col("host") == F.col("__host"))
                   .where(F.col("c") > F.col("docs") * max_share).select("host", "line", "c"))


def _without_first(hits: DataFrame, stats: DataFrame, n_common: int) -> DataFrame:
    """Common lines in texts, less those in the text that keeps them: of each (host, line), the one with the
    smallest doc_id that passes the base rules."""
    failed = stats.select(F.col("doc_id").alias("__i"), F.col("t").alias("__t"), F.col("host").alias("__h"), "base_failed").distinct()
    of = F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("t") == F.col("__t")) & (F.col("host") == F.col("__h"))
    first = scratch(hits.join(failed, of).groupBy(F.col("host").alias("__h"), F.col("line").alias("__l"))
                    .agg(F.min(F.struct("base_failed", F.col("doc_id").isNull(), "doc_id", "t"))["t"].alias("__t")))
    return hits.join(small(first, n_common), (F.col("host") == F.col("__h")) & (F.col("line") == F.col("__l"))).where("t != __t")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, max_lost: float = MAX_LOST,
                  keep_places: bool = False, keep_first: bool = False) -> DataFrame:
    """(doc_id, counts, removed_words, base_failed, kept, and the hashes t and host of text and host), one row for each row of ``docs``;
    with ``keep_places`` also the numbers of the lines that are removed (null: none)."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                    F.xxhash64(F.col(host_col).cast("string")).alias("host"),
                    F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("t"))
    common = common_lines(d, max_share, min_docs).select(F.col("host").alias("__host"), F.col("line").alias("__line"))
    n_common = common.count()
    hits = _lines(d).join(small(common, n_common), (F.col("host") == F.col("__host")) & (F.col("line") == F.col("__line")))
    stats = base_stats(d)
    if keep_first:
        stats = scratch(stats)
        hits = _without_first(scratch(hits.select("doc_id", "t", "host", "place", "line", "words").distinct()), stats, n_common)
    lost = (hits.select("doc_id", "t", "host", "place", "words").distinct()  # repeated rows count once
            .groupBy(F.col("doc_id").alias("__i"), F.col("t").alias("__t"), F.col("host").alias("__h"))
            .agg(F.sum("words").cast("long").alias("removed_words"), *[F.sort_array(F.collect_list("place")).alias("places")] * keep_places))
    out = stats.join(
        lost, F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("t") == F.col("__t")) & (F.col("host") == F.col("__h")), "left")
    removed = F.coalesce("removed_words", F.lit(0).cast("long"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        removed.alias("removed_words"), "t", "host",
        (~F.col("base_failed") & (removed <= F.col("n_words") * max_lost)).alias("kept"), *["places"] * keep_places)


def clean_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns, their text without the common lines of the host. The verdict
    depends on (id, text, host), so a repeated id is judged text by text."""
    verdict = quality_rules(docs, id_col, text_col, host_col, keep_places=True, **limits)
    changed = scratch(verdict.where("NOT kept OR places IS NOT NULL").select(
        F.col("doc_id").alias("__i"), F.col("t").alias("__u"), F.col("host").alias("__g"), F.col("kept").alias("__kept"),
        F.when(F.col("kept"), F.col("places")).alias("__places")).distinct())
    text = F.col(text_col).cast("string")
    keyed = docs.withColumn("__t", F.xxhash64(F.coalesce(text, F.lit("")))).withColumn("__h", F.xxhash64(F.col(host_col).cast("string")))
    on = F.col(id_col).cast("long").eqNullSafe(F.col("__i")) & (F.col("__t") == F.col("__u")) & (F.col("__h") == F.col("__g"))
    left = F.array_join(F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains("__places", i)), "\n")
    return (keyed.join(small(changed, changed.count(), CHANGED), on, "left").where(F.coalesce("__kept", F.lit(True)))
            .withColumn(text_col, F.when(F.col("__places").isNull(), F.col(text_col)).otherwise(left)).select(*docs.columns))
