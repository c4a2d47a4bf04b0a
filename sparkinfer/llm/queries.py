"""The registered queries of this subpackage; operators are in the other modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkinfer.llm import (decontaminate, exact, language, near, ngram_join, packing, prefix_trie, secrets, sharding, suffixes,
                            token_files, urls, whitening)
from sparkinfer.llm.common import scratch_path, table, text_of

#: Public tokenizer file of the token queries.
TOKENIZER = "word_bpe_49k.json"
#: Public vocabulary of the language model.
PIECES = "piece_bpe_32k.model"
SHARDS = 40
# The url rules, as (verdict, host, path).
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES)


def op1_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text").cast("string")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(16)).alias("size"),
        F.crc32(text_of("text").cast("binary")).alias("text_crc32"))
    return sharding.shard(rows, "doc_id", SHARDS, ["text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path(), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "tier", "step_id")


def op3_interval_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_spans(table(spark, sf_dir, "documents"), "doc_id", "text", length=200)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.coalesce(F.sha2("kept", 256), F.col("text_sha256")).alias("kept_sha256"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), "page_id", "url", rules)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, "doc_id", "text", tokenizer_path(), 1)
    digests = token_files.ids_crc32(token_files.read_token_files(spark, path), "ids", "ids_crc32")
    return digests.select("doc_id", "start", "n_tokens", "ids_crc32")


def _joined_spans(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"), "doc_id", "text")
    base = F.filter("found", lambda s: s["order"] < len(secrets.BASE_RULES))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in secrets.BASE_RULES]
    return found.select("doc_id", *counts, F.sha2(_joined_spans(base), 256).alias("base_sha256"),
                        _joined_spans(F.col("found")).alias("spans"))


def op7_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), "doc_id", "text",
                                    table(spark, sf_dir, "benchmark"), "item_id", "text").withColumnRenamed("item", "item_id")


def held_out(doc_id: str) -> Column:
    """Whether a row is kept for testing; never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op8_piece_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language.learn_languages(documents.where(~held_out("doc_id")), "text", "lang", pieces_path())
    rows = documents.select("doc_id", "text", held_out("doc_id").alias("held_out"))
    return language.predict_language(rows, "text", model).select("doc_id", "held_out", "lang_pred", "score")


def op9_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_groups(table(spark, sf_dir, "documents"), "doc_id", "text", k=2, percent=80)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"), "doc_id", "text")


def op11_token_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"), "doc_id", "text", k=3, percent=90)


def op12_jacobi_davidson(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return whitening.whiten(embeddings, "vec_id", "embedding", whitening.fit_whitening(embeddings, "embedding", 16))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    def opening(conv: Column) -> Column:
        return F.crc32(conv.cast("string").cast("binary")) % 6

    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text",
                                   openings=(100, opening, 5))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_jump_shards, op2_tier_packing, op3_interval_expansion, op4_url_rules, op5_token_files, op6_secret_spans,
                            op7_simhash_windows, op8_piece_languages, op9_super_minhash, op10_exact_dedup,
                            op11_token_combinations, op12_jacobi_davidson, op13_prefix_trie)
}
