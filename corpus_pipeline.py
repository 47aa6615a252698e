"""A training-data pipeline over ``documents``: five stages, each one operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``. Empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.bpe import encode_decode
from spanloom.llm.decontaminate import decontaminate
from spanloom.llm.near import keep_first, near_duplicates
from spanloom.llm.pseudonyms import pseudonymise
from spanloom.llm.quality import document_features, fit, keep_quality, remainder
from spanloom.llm.queries import pseudonym_key
from spanloom.llm.stages import written
from spanloom.session import table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier, trained on the labelled ones
    among ``docs``, scores under 0.7. Without usable labels nothing is dropped."""
    part = remainder("doc_id", 4)
    model = fit(document_features(docs), table(spark, sf_dir, "labels"), ridge_rows=part.isin(0, 1), calibration_rows=part == 3)
    return docs if model.weights is None else keep_quality(docs, model)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near duplicates."""
    return keep_first(docs, near_duplicates(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that overlap a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonymise personal data inside the texts; no document goes."""
    new = pseudonymise(docs, key=pseudonym_key(spark))
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.col("n_replaced") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return new.select(*docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256`` of every document."""
    return encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), outputs=("ids", "decoded_sha256"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pii),
    ("bpe", bpe),
]

#: No SQL: the classifier's training and the encoder have none; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for step, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if step < len(STAGES) - 1:
            docs = written(docs)
    return docs
