"""The subpackage's queries, over whole tables with production parameters, and their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import bpe, conversations, html_text, near_dedup, packing, quality, rollups, sharding, sql, suffix_dedup, topk, toxicity, whitening
from sieveline.llm.common import shared_dir, table

#: Vocabularies: (file, split pattern of rank files).
GPT_50K = (public_tokenizers.path("byte_bpe_50k.json"), None)
MULTI_50K = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"


def op1_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards of equal row counts."""
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    slim = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = sharding.shard(slim, 16, order=["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op2_bfd_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed id matrices of 1024 columns."""
    return packing.pack_matrix(table(spark, sf_dir, "documents"), *GPT_50K)


def op3_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by source, language and tokenizer version of all documents, after copies have gone and addresses been masked.

    Four batches: all documents arrive; of equal texts all but the smallest id's go; what holds e-mail addresses is revised; and
    the first batch comes once more, which changes nothing. Totals are read from a base and no batch after it.
    """
    at, kinds = f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}", {"byte_bpe_50k": GPT_50K, "byte_bpe_multi_50k": MULTI_50K}
    rollup, docs = rollups.Rollup(spark, at), table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    copies = rollups.copies(docs, f"{at}-copies")
    copy = (F.sha2(docs["text"], 256) == copies["digest"]) & (docs["doc_id"] > copies["first"])
    masked = F.regexp_replace("text", EMAIL, "<email>")
    revised = docs.where(F.col("text").contains("@") & F.col("text").rlike(EMAIL)).join(copies, copy, "left_anti")
    rollup.apply("arrival", docs, kinds)
    rollup.apply("copies", docs.join(copies, copy, "left_semi").withColumn("sign", F.lit(-1)), kinds)
    rollup.apply("masking", revised.withColumn("sign", F.explode(F.array(F.lit(-1), F.lit(1)))).withColumn("text", F.when(F.col("sign") > 0, masked).otherwise(F.col("text"))), kinds)
    rollup.apply("arrival", docs, kinds)
    rollup.compact()
    return rollup.totals()


def op4_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every 50th vector among all others."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op6_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that documents share."""
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 2-word shingles are similar by 0.8 or more."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), n_words=2, threshold=0.8)


def op8_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers for all documents."""
    return quality.quality(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text to ids and back."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), *MULTI_50K)


def op10_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids."""
    return packing.pack_pieces(table(spark, sf_dir, "documents"), *GPT_50K)


def op11_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), k=4, scale=256)


def op12_text_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_trie_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation."""
    return conversations.repair(table(spark, sf_dir, "conversations"))


def sharding_laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the law of op1 promises, from its result: counts per shard, distinct places, gaps in the slots, and all bytes."""
    shards = op1_feistel_sharding(spark, sf_dir).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("slot").alias("slots"), (F.max("slot") + 1).alias("reach"), F.sum("size").alias("size"))
    sums = [F.min("n").alias("least_rows"), F.max("n").alias("most_rows"), F.sum("n").alias("n_rows"), F.sum("slots").alias("n_places"), F.sum(F.col("reach") - F.col("slots")).alias("gaps"), F.sum("size").alias("bytes")]
    return shards.agg(*sums).select(F.lit("rows").alias("law"), "*")


def whitening_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n and the exact deviations of op11, which SQL can tell."""
    return op11_lanczos_whitening(spark, sf_dir).where("component = 1").select("vec_id", "n", "deviation")


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base statistics and rules of op8 for all documents."""
    return quality.base_statistics(table(spark, sf_dir, "documents"), keys=["doc_id"]).drop("n_lines")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_feistel_sharding, op2_bfd_matrix, op3_token_rollup, op4_text_density, op5_ball_tree, op6_sparse_suffixes, op7_lsh_forest, op8_quality_mcd, op9_byte_bpe, op10_bin_slack_packing, op11_lanczos_whitening, op12_text_cnn, op13_trie_repair, sharding_laws, quality_base, whitening_deviations)
}
#: SQL tells searches, near-duplicates, the base rules, deviations and what sharding promises. Keyed permutations, vocabularies, packing,
#: robust estimates, components, trained models and repairs it can't; tests hold these against brute force or held-out rows.
ORACLES: dict[str, str] = {"op5_ball_tree": sql.OP5, "op7_lsh_forest": sql.OP7, "sharding_laws": sql.SHARDING_LAWS, "quality_base": sql.QUALITY_BASE, "whitening_deviations": sql.DEVIATIONS}
