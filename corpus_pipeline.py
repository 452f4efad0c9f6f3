"""Corpus pipeline: toxicity, near duplicates, benchmark leaks, secrets, tokens.

Each stage reads the documents that the stage before has kept and written, whole, and returns
the columns of ``documents``; the last one returns the tokens.  Null, empty, very long, equal
and repeated rows are handled as the operators of ``tillwork.llm`` say; rows without doc_id
are kept by every stage that joins on it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork.llm import decontamination, minhash, secrets_scan, sentencepiece_fst, toxicity
from tillwork.llm.queries import TOKENIZER
from tillwork.llm.spark_util import free_name, use_checkpoint_dir


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a toxic grade go; the model is fitted on the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels, toxicity.label_grade(), toxicity.LABEL_GRADES, toxicity.LABEL_TOXIC)
    flag = free_name(docs, *toxicity.NAMES)[-1]
    return toxicity.score_toxicity(docs, model).where(~F.col(flag)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at 0.8 of five-word shingles, the document with the least doc_id stays."""
    gone = minhash.near_duplicates(docs, width=5, percent=80).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised ones too, go."""
    flag = free_name(docs, "contaminated", "items", "coverage")[0]
    flagged = decontamination.flag_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return flagged.where(~F.col(flag)).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows the text."""
    out = secrets_scan.redact_secrets(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the token ids of each text."""
    tokens = sentencepiece_fst.encode_texts(docs.select("doc_id", "text"), TOKENIZER)
    return tokens.select("doc_id", "ids", "n_tokens", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("sentencepiece", tokenise),
]

#: no SQL for a fitted model, near-duplicate components and token paths; tests hold each stage
#: against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; each result is written as Parquet in the shared folder that
    ``spark.checkpoint.dir`` names, and read again by the next stage."""
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
