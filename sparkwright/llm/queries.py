"""Registered queries: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm import centroids, filter_audit, mixing, quality_rules
from sparkwright.llm.common import read_documents


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of nearly equal bytes."""
    from sparkwright.llm.shards import byte_shards, sizes
    return byte_shards(sizes(read_documents(spark, sf_dir)), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the threshold table for every document."""
    from sparkwright.llm.quality_rules import apply_rules
    return apply_rules(read_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed_rules")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    from sparkwright.llm.licenses import scan
    return scan(read_documents(spark, sf_dir)).drop("detections")


def op6_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text decoded from them, as digests."""
    import public_tokenizers
    from sparkwright.llm.bpe import digests
    return digests(read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 13-word runs that start in a smaller document."""
    from sparkwright.llm.substrings import remove_repeats
    return remove_repeats(read_documents(spark, sf_dir), 13).select(
        "doc_id", "n_words", "n_removed",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    from sparkwright.llm.simhash import near_duplicates
    return near_duplicates(read_documents(spark, sf_dir), 3, 3).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    from sparkwright.llm.neighbours import search
    vectors = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    return search(vectors, F.col("vec_id") % 20 == 0, k=20)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from sparkwright.llm.style_tree import main_text
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return main_text(pages).withColumn("n_chars", F.length("text").cast("long"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from preference pairs of labelled rows."""
    from sparkwright.llm.preference import CUT, held_out, score, train
    docs = read_documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling probability and draw of every document under raked source, language and topic weights."""
    from sparkwright.llm.mixing import sample
    return sample(read_documents(spark, sf_dir)).select(
        "doc_id", "source", "lang", "topic", "n_tokens",
        F.round("probability", 9).alias("probability"), "selected")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from every source, at every step of all 120 orders."""
    docs = read_documents(spark, sf_dir)
    return filter_audit.audit(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of 5-word shingles and its class under similarity 0.8."""
    from sparkwright.llm.jaccard import near_duplicates
    return near_duplicates(read_documents(spark, sf_dir), 5, 80).select("doc_id", "n_shingles", "component_id", "n_links")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, exact distance and inertia of every embedding after five rounds with 40 centroids."""
    return centroids.cluster(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


JOBS = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_html_extraction": op5_html_extraction,
    "op6_bpe_encoding": op6_bpe_encoding,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_source_mixing": op9_source_mixing,
    "op10_byte_shards": op10_byte_shards,
    "op11_filter_audit": op11_filter_audit,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_centroid_clustering": op13_centroid_clustering,
}
ORACLE: dict[str, str] = {
    "op1_substring_dedup": """
WITH w AS (SELECT row_number() OVER () AS rid, doc_id,
                  coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents),
p AS (SELECT rid, doc_id, i, list_aggregate(words[i:i + 12], 'string_agg', ' ') AS win
      FROM (SELECT rid, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
m AS (SELECT win, min(doc_id) AS least FROM p GROUP BY win),
f AS (SELECT rid, i FROM p JOIN m USING (win) WHERE least < doc_id),
c AS (SELECT DISTINCT rid, i + k AS j FROM f, range(13) r(k)),
g AS (SELECT rid, count(*) AS n, list(j) AS gone FROM c GROUP BY rid),
x AS (SELECT rid, doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM w),
k AS (SELECT x.rid, string_agg(word, ' ' ORDER BY x.j) AS kept
      FROM x LEFT JOIN c ON x.rid = c.rid AND x.j = c.j WHERE c.j IS NULL GROUP BY x.rid)
SELECT doc_id, len(words)::bigint AS n_words, coalesce(g.n, 0)::bigint AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN g ON w.rid = g.rid LEFT JOIN k ON w.rid = k.rid""",
    "op7_quality_rules": quality_rules.oracle_sql(),
    "op9_source_mixing": mixing.oracle_sql(),
    "op11_filter_audit": filter_audit.oracle_sql(),
    "op13_centroid_clustering": centroids.oracle_sql(),
}
