"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork.llm import decontamination, fill_middle, fingerprints, licenses, minhash, pii, secrets_scan, sentencepiece_fst, sharding, substring_dedup, toxicity, url_filters, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=2, percent=80)


#: the model file that is read on the driver; a fixed place of the machines this runs on
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_fst.encode_texts(docs, TOKENIZER).drop("text")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentences", ",").alias("sentences"), F.array_join("licenses", ",").alias("licenses"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"), toxicity.label_grade(), toxicity.LABEL_GRADES, toxicity.LABEL_TOXIC)
    return toxicity.score_toxicity(docs, model).drop("text")


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    found = url_filters.filter_urls(pages, url_filters.rule_labels(pages))
    return found.select("page_id", "host", "path", "rule", "verdict", "block_probability")


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.scan_secrets(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    base = F.filter("spans", lambda s: s.kind.isin([r.kind for r in secrets_scan.BASE_RULES]))
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
                        F.sha2(secrets_scan.joined(base), 256).alias("base_sha256"), secrets_scan.joined(F.col("spans")).alias("spans"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), "removed")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.flag_contaminated(docs, _table(spark, sf_dir, "benchmark")).drop("text")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=8)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    base = F.filter("spans", lambda s: s.kind != pii.TERM)
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in pii.KINDS), F.sha2(secrets_scan.joined(base), 256).alias("base_sha256"),
                        secrets_scan.joined(F.col("spans")).alias("spans"), F.sha2("sanitised", 256).alias("sanitised_sha256"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.fill_middle(_table(spark, sf_dir, "documents"), seed=42, rate=50, spm=80)
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=32)


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_license_scans": op2_license_scans,
    "op3_toxicity": op3_toxicity,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_url_filters": op5_url_filters,
    "op6_secret_scans": op6_secret_scans,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_sharding": op10_sharding,
    "op11_pii": op11_pii,
    "op12_fill_middle": op12_fill_middle,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op2_license_scans": licenses.duckdb_sql("documents"),
    "op11_pii": pii.duckdb_sql("documents"),
    "op12_fill_middle": fill_middle.duckdb_sql("documents"),
}
