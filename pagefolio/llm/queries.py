"""The registered query of each operator: it reads the whole table and derives the result columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagefolio.llm import (
    byte_bpe,
    conversation_repair,
    language_id,
    lexical_search,
    near_duplicates,
    neighbour_graph,
    ngram_trie,
    packing,
    page_text,
    personal_data,
    quality_rules,
    token_counts,
    url_filter,
)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    learned = language_id.remainder(F.col("doc_id"), 7) != 2
    scored = ngram_trie.scored_texts(docs, learned)
    return scored.withColumn("held_out", ~F.col("learned")).drop("learned")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates.near_duplicate_groups(docs, size=2).drop("class_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encoded(docs, ranks, public_tokenizers.PATTERN, digests=True)


def op4_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_graph.embedding_groups(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language_id.train(docs)
    held_out = (language_id.remainder(F.col("doc_id"), 4) == 2).alias("held_out")
    return language_id.predictions(docs.select("doc_id", held_out, "text"), model)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return personal_data.personal_spans(docs, personal_data.train(docs))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages", "page_id", "url")).drop("log_odds")


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return page_text.main_texts(pages, page_text.train(pages)).drop("n_blocks")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lexical_search.ranked(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conversation_repair.repaired_conversations(conversations)


QUERIES = {
    "op1_ngram_trie": op1_ngram_trie,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_embedding_groups": op4_embedding_groups,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_id": op6_language_id,
    "op7_personal_data": op7_personal_data,
    "op8_url_filter": op8_url_filter,
    "op9_page_text": op9_page_text,
    "op10_packing": op10_packing,
    "op11_lexical_search": op11_lexical_search,
    "op12_token_counts": op12_token_counts,
    "op13_conversation_repair": op13_conversation_repair,
}

# The words of a text in DuckDB. Its regular expressions know the six ASCII white space characters.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# ``links (a, b)`` to ``component``: the smallest id that links lead to.
_COMPONENTS = """
sym AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (SELECT a, b FROM sym UNION SELECT reach.id, sym.b FROM reach JOIN sym ON sym.a = reach.other),
component AS (SELECT id, least(id, min(other)) AS component_id FROM reach GROUP BY id)
"""

ORACLES = {
    "op2_near_duplicates": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS v
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.v = y.v AND x.doc_id < y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
), {_COMPONENTS}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
  coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN component ON component.id = d.doc_id
""",
    "op4_embedding_groups": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.95
), {_COMPONENTS},
n AS (SELECT a, count(*) AS n FROM sym GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
  coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN component ON component.id = vec_id LEFT JOIN n ON n.a = vec_id
""",
    # A window is the text of its eight words; words hold no spaces, so equal texts are equal windows.
    "op5_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents
),
win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, v) AS c FROM (
    SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS v
    FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d))
),
rep AS (
  SELECT rid, count(DISTINCT i + j) AS n
  FROM win, (SELECT unnest(range(8)) AS j) WHERE c > 1 GROUP BY rid
),
m AS (
  SELECT doc_id, w, len(w) AS n_words, list_sum(list_transform(w, lambda x: length(x))) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
    coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (rid)
),
n AS (
  SELECT *, len(l) - len(list_distinct(l)) AS n_dup_lines,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM m
)
SELECT doc_id, n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, n_symbols, n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed
  AND 10 * n_symbols <= 3 * n_words
  AND coalesce(word_chars, 0) BETWEEN 2 * n_words AND 20 * n_words
  AND 2 * n_dup_lines <= len(l)
  AND 10 * len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) <= 3 * n_words
  AND 10 * len(list_filter(w, lambda x: regexp_matches(x, '\pL'))) >= 6 * n_words
  AND 2 * len(list_filter(w, lambda x: length(x) > 1 AND x = upper(x) AND x <> lower(x))) <= n_words AS kept
FROM n
""",
    # Terms, weights and scores as the contract states them; integer division of non-negative
    # numbers is the // of DuckDB.
    "op11_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
),
p AS (SELECT rid, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d WHERE len(t) > 0),
tot AS (SELECT count(*) AS big_n, sum(len(t)) AS big_l FROM d WHERE len(t) > 0),
tf AS (SELECT rid, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM p GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
),
s AS (
  SELECT q.item_id, tf.rid, tf.doc_id, sum(
    CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df.df + 1))) AS BIGINT)
    * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * tf.n * big_n) // big_l)))) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term), tot
  GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST, rid) AS rank
  FROM s WHERE score > 0)
WHERE rank <= 10
""",
}
