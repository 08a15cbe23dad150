"""Registered queries of this subpackage and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, ann, bpe, conversation_trie, exact_dedup, langid, packing, quality, simhash, suffix_dedup, token_store, toxicity, url_filter
from .common import Scratch, documents


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens, by minimum bin slack."""
    return packing.pack_documents(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as a token-id store and read back from its files."""
    path = Scratch(spark, "token-store").path("store")
    token_store.write_store(documents(spark, sf_dir), path, tokenizer("word_bpe_49k.json"))
    return token_store.read_store(spark, path)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays of its group of equal texts."""
    return exact_dedup.duplicate_groups(documents(spark, sf_dir))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what remains when repeated 200-byte strings go."""
    return suffix_dedup.removal_report(documents(spark, sf_dir))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its SimHash fingerprint and near-duplicate component."""
    return simhash.near_duplicate_groups(documents(spark, sf_dir))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through batched BPE encoding and decoding."""
    return bpe.encode_and_decode(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of every 100th embedding among all."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("cast(vec_id as long) id", "embedding vector")
    return ann.nearest(vectors, vectors.where("id % 100 = 0"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its pairwise-ranking quality score."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.scores(docs, labels, quality.train(docs, labels))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its expected severity and whether it is toxic."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.severities(docs, toxicity.train(docs, labels))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its language by a byte convolutional network."""
    docs = documents(spark, sf_dir)
    return langid.languages(docs, langid.train(docs))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the conversations rebuilt upon shared heads."""
    return conversation_trie.rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), group=5, heads=9)


URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by the ratio of two Markov models."""
    return url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's alignment between a byte-level and a piece vocabulary."""
    return alignment.alignments(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


OP9_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY text)
"""

OP11_SQL = """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
         sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list({'d': digest, 'n': strlen(text)} ORDER BY turn NULLS FIRST,
                 digest >= '8' DESC, substr(digest, 1, 16), substr(digest, 17, 16) >= '8' DESC, substr(digest, 17, 16)) AS path
  FROM turns GROUP BY c
), heads AS (
  SELECT c, path, (xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))),
           4294967295::UBIGINT) % 9)::BIGINT AS h
  FROM own
), rebuilt AS (
  SELECT t.c, list_concat(coalesce(b.path, [])[1:t.h], t.path[t.h + 1:]) AS path
  FROM heads t LEFT JOIN own b ON b.c = t.c - t.c % 5
), prefixes AS (
  SELECT c, path, d, path[1:d] AS node FROM rebuilt, unnest(range(0, len(path) + 1)) AS u(d)
), nodes AS (
  SELECT node, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(path) = d), '')) AS ends_sha256
  FROM prefixes GROUP BY node
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, n.node[1:n.depth - 1] AS up
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
), children AS (
  SELECT up AS node, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY up
), subtrees AS (
  SELECT n.node[1:k] AS node, sum(CASE WHEN c.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves,
         sum(CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * n.node[n.depth].n ELSE 0 END) AS saved_tokens
  FROM nodes n LEFT JOIN children c USING (node), unnest(range(0, n.depth + 1)) AS u(k) GROUP BY 1
)
SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, coalesce(c.n_children, 0) AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, l.ends_sha256
FROM linked l LEFT JOIN children c USING (node) JOIN subtrees s USING (node)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_token_store": op2_token_store,
        "op3_ann": op3_ann,
        "op4_quality": op4_quality,
        "op5_simhash_near_dedup": op5_simhash_near_dedup,
        "op6_toxicity": op6_toxicity,
        "op7_bpe": op7_bpe,
        "op8_language_id": op8_language_id,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_conversation_trie": op11_conversation_trie,
        "op12_url_filter": op12_url_filter,
        "op13_alignment": op13_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op9_exact_dedup": OP9_SQL,
        "op11_conversation_trie": OP11_SQL,
    }
