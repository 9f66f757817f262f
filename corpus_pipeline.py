"""Corpus pipeline: quality rules, exact dedup, near-duplicate dedup, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``. A stage that begins
deletes the scratch tables of the one before, whose result is written by then.

Edge cases: an empty table gives an empty result; a null text, a null doc_id and repeated rows are what each operator
states; a table without ``n_chars`` stays without it."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoforge.llm.common import having_ids, read_documents, recorded, remove, scratch, small_batches
from chronoforge.llm.exact_dedup import drop_copies
from chronoforge.llm.ngram_join import ngram_join
from chronoforge.llm.packing import pack
from chronoforge.llm.quality_rules import clean_texts
from chronoforge.llm.queries import PACK_TOKENIZER
from chronoforge.llm.suffix_dedup import cut_texts


#: scratch tables of the stage before, by application
_LEFT: dict[str, list[str]] = {}


def _stage(function):
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        names = _LEFT.pop(app, [])
        if not any(name in file for file in docs.inputFiles() for name in names):  # docs were not written: they still read them
            remove(spark, names)
        with recorded() as names, small_batches(spark):
            out = function(spark, docs, sf_dir)
        _LEFT[app] = names
        return out

    return run_stage


def _with_length(texts: DataFrame, docs: DataFrame) -> DataFrame:
    """``texts`` with the columns of ``docs``, ``n_chars`` counted anew where there is one."""
    if "n_chars" in docs.columns:
        texts = texts.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return texts.select(*docs.columns)


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the common lines of their host. One text keeps each line, so
    that a large group of near copies is not lost before its own stage."""
    return _with_length(clean_texts(docs, keep_first=True), docs)


@_stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    found = ngram_join(docs)
    return having_ids(docs, scratch(found.where("component_id != doc_id").select(F.col("doc_id").alias("id"))), "left_anti")


@_stage
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that an earlier document has already; written here, so that they are cut in small batches."""
    return scratch(_with_length(cut_texts(docs), docs))


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    return pack(docs, PACK_TOKENIZER)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("ngram_join", near), ("suffix_dedup", passages), ("packing", packing)]

#: byte-pair encoding and the packing program have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = read_documents(spark, sf_dir), []
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        with recorded() as written, small_batches(spark):
            docs = scratch(out)
        remove(spark, read)
        read = written
