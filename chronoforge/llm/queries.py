"""The queries of this subpackage and their DuckDB twins (None of them reads less than its table)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from chronoforge.llm.byte_bpe import byte_bpe
from chronoforge.llm.common import read_documents
from chronoforge.llm.exact_dedup import exact_dedup
from chronoforge.llm.hilbert_sharding import hilbert_shards
from chronoforge.llm.lexical_search import build_index, search
from chronoforge.llm.line_quality import line_quality
from chronoforge.llm.ngram_join import ngram_join
from chronoforge.llm.packing import pack
from chronoforge.llm.prefix_trie import prefix_trie
from chronoforge.llm.quality_rules import quality_rules
from chronoforge.llm.sentence_spans import sentence_spans
from chronoforge.llm.simhash_near import simhash_near
from chronoforge.llm.suffix_dedup import suffix_dedup
from chronoforge.llm.toxicity import toxicity

#: vocabulary files, read where they are installed
PACK_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
BPE_TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_documents(spark, sf_dir), _labels(spark, sf_dir))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_documents(spark, sf_dir), PACK_TOKENIZER)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read_documents(spark, sf_dir))


def op4_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(read_documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_documents(spark, sf_dir))


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans(read_documents(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_documents(spark, sf_dir)).drop("t", "host")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(read_documents(spark, sf_dir), BPE_TOKENIZER)


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(read_documents(spark, sf_dir), _labels(spark, sf_dir))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read_documents(spark, sf_dir))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(read_documents(spark, sf_dir)), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_simhash_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near(read_documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_toxicity, op2_best_fit_packing, op3_suffix_dedup, op4_hilbert_sharding, op5_exact_dedup,
    op6_sentence_spans, op7_quality_rules, op8_byte_bpe, op9_line_quality, op10_ngram_join, op11_lexical_search,
    op12_simhash_near, op13_prefix_trie)}

ORACLE: dict[str, str] = {}

ORACLE["op5_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

ORACLE["op7_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT doc_id, a, b, c FROM windows GROUP BY ALL HAVING count(*) > 1),
places AS (
  SELECT doc_id, i, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 3) AS gap
  FROM windows JOIN twice USING (doc_id, a, b, c)),
repeats AS (SELECT doc_id, sum(least(gap, 3))::BIGINT AS n_repeat_words FROM places GROUP BY doc_id),
rows_ AS (
  SELECT doc_id, host, text, trim(regexp_replace(lower(x), '[\x20\x09\x0B-\x0D]+', ' ', 'g')) AS line
  FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS x FROM d)),
hosts AS (SELECT host, count(DISTINCT text) AS docs FROM d GROUP BY host),
common AS (
  SELECT host, line FROM rows_ JOIN hosts USING (host) WHERE line <> ''
  GROUP BY host, line, docs HAVING count(DISTINCT text) > 10 AND count(DISTINCT text) > docs * 0.05),
lost AS (
  SELECT doc_id, sum(len(line) - len(replace(line, ' ', '')) + 1)::BIGINT AS removed_words
  FROM rows_ JOIN common USING (host, line) GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed_words, 0) AS removed_words
  FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN lost USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words,
       NOT base_failed AND removed_words <= n_words * 0.5 AS kept
FROM judged
"""

ORACLE["op11_lexical_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
postings AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY 1),
totals AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, totals GROUP BY term, big_n),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))) AS part
  FROM postings JOIN sizes USING (doc_id) JOIN weights USING (term), totals),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL HAVING sum(part) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE["op13_prefix_trie"] = r"""
WITH turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (
  SELECT conv_id, own, (4294967295 - list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END))) % 6 AS h
  FROM turns),
paths AS (
  SELECT c.conv_id, list_concat(coalesce(b.own, c.own[1:0])[1:c.h], c.own[c.h + 1:]) AS path
  FROM heads c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (
  SELECT conv_id, depth, path[1:depth] AS prefix, len(path) AS len_path
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM paths)),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS top, count(*) AS n,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len_path = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY prefix, depth),
places AS (SELECT p.conv_id, p.depth, n.top, n.n, CASE WHEN p.depth > 0 THEN len(p.prefix[p.depth].text) ELSE 0 END AS chars
           FROM prefixes p JOIN nodes n USING (prefix, depth)),
tree AS (
  SELECT n.top AS conv_id, n.depth, up.top AS parent_conv_id, n.n AS n_convs, n.ends_sha256, own.chars
  FROM nodes n JOIN places own ON own.conv_id = n.top AND own.depth = n.depth
  LEFT JOIN places up ON up.conv_id = n.top AND up.depth = n.depth - 1),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM tree WHERE depth > 0 GROUP BY ALL),
sums AS (
  SELECT a.top AS conv_id, a.depth, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves, sum((t.n_convs - 1) * t.chars) AS saved_tokens
  FROM tree t JOIN places a ON a.conv_id = t.conv_id AND a.depth <= t.depth
  LEFT JOIN children c ON c.conv_id = t.conv_id AND c.depth = t.depth
  GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM tree JOIN sums USING (conv_id, depth) LEFT JOIN children USING (conv_id, depth)
"""
