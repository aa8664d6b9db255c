"""Corpus pipeline over ``documents``: toxicity, near duplicates, benchmark leaks, personal data, tokens.

Each stage is written and read again before the next. All stages but the last return the columns of
documents. Stages that drop rows number the rows of their input, so that null and repeated ids do no
harm; the input of a stage is read more than once and has to be stored, as ``run`` does.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm import bpe_words, lsa_decontam, near_shingles, pii_disclosure, toxicity_gru
from sluice.scratch import materialize

_ROW = "row number of the stage"
_BATCH = 500  # documents sent to a Python worker at a time
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _short_batches(spark: SparkSession) -> None:
    """Sends Python workers ``_BATCH`` rows at most, as texts are long; what a stage returns runs later, so the session keeps this."""
    if not 0 < int(spark.conf.get(_ARROW_ROWS)) <= _BATCH:
        spark.conf.set(_ARROW_ROWS, _BATCH)


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_ROW, F.monotonically_increasing_id())


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the network learns from the same rows as query op3."""
    _short_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    scored = toxicity_gru.with_score(docs, toxicity_gru.fit(docs, labels), name="score of the stage")
    return scored.filter(F.col("score of the stage") < toxicity_gru.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; a null id comes last."""
    _short_batches(spark)
    rows = _numbered(docs)
    groups = near_shingles.near_duplicates(rows, id_col=_ROW).select(F.col("id").alias(_ROW), "component")
    ids = rows.select(_ROW, F.col("doc_id").alias("own"))
    first = F.min(F.struct(F.col("own").isNull(), "own", F.col(_ROW).alias("row"))).alias("first")
    kept = materialize(groups.join(ids, _ROW).groupBy("component").agg(first).select(F.col("first.row").alias(_ROW)), "kept")
    return rows.join(kept, _ROW, "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    _short_batches(spark)
    rows = _numbered(docs)
    leaks = lsa_decontam.find_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=_ROW)
    leaking = materialize(leaks.select(F.col("id").alias(_ROW)).distinct(), "leaking")
    return rows.join(leaking, _ROW, "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and terms that disclose it replaced; ``n_chars`` follows."""
    clean = pii_disclosure.sanitise(docs)
    if "n_chars" in docs.columns:
        length = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
        clean = clean.withColumn("n_chars", length)
    return clean.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the bytes that they decode to."""
    _short_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    # Stored, so that a task has one Python worker at a time: that which encodes, or that which decodes.
    encoded = materialize(bpe_words.encode(docs, ranks, public_tokenizers.PATTERN), "encoded", arrow_rows=_BATCH)
    return bpe_words.decode(encoded, ranks).select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("data", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: SQL expresses none of the network, the fingerprints and the latent space.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}", arrow_rows=_BATCH)
    return STAGES[-1][1](spark, docs, sf_dir)
