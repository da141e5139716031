"""A training corpus from ``documents``: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, common, mixing, near_dedup, secrets
from millrace.llm import toxicity as tox

#: Learned models, alignment and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not call toxic, as they are.

    Null and empty texts have the model's base score and stay with all but few
    labels of clean ones; repeated rows go or stay together; without labels
    every score is 0.5 and nothing is known to be clean or toxic: all rows stay.
    An empty table stays empty, and columns may have any names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    (mark,) = common.fresh(docs, "toxic_score")
    scored = tox.score(docs, tox.learn_from(docs, labels), score_col=mark)
    return scored.filter((F.col(mark) < 0.5) | F.lit(labels.isEmpty())).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of the least doc_id (null last), as it is.

    Null and empty texts are one class, texts of less than five words have exact
    copies only, and of repeated rows one stays.
    """
    return near_dedup.deduplicate(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced and ``n_chars`` counted anew; null and empty texts, repeated rows and ties as they are."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents of scarce sources repeat, those of plentiful ones are thinned to the budget.

    Documents without a word (null and empty texts) have nothing to take and go;
    a null source is a source; repeated rows share what the mix takes of them.
    """
    return mixing.mixed_documents(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix, each copy by itself; null text has no tokens."""
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next; an empty table gives no rows."""
    docs, last = common.documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name)
        common.discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
