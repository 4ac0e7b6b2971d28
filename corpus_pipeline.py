"""From raw documents to encoded training text: filter, deduplicate, mix, encode.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``; those with Python workers set the session's Arrow batches to ``BATCH_ROWS``. All but the last return the columns of ``docs``, extra ones of
any name included. Null and empty texts are scored like any other text, count as equal to each other in the
exact stage, are linked with nothing in the near stage and are never taken by the mix (they have no
words). An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lingofold.llm import exact_dedup, mixing, near_dedup, piece_sampling, quality_model
from lingofold.llm.common import read
from lingofold.session import stage_table

#: Lattice edges per worker: small, as workers still hold memory of earlier stages.
KEPT_EDGES = 500_000
#: Rows that Spark hands to a Python worker at once; both hold such a batch of whole texts.
BATCH_ROWS = 1_000
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    spark.conf.set(BATCH_CONF, BATCH_ROWS)
    return quality_model.accepted(docs, quality_model.fit(docs, read(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    spark.conf.set(BATCH_CONF, BATCH_ROWS)
    return near_dedup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document: doc_id, sample, ids, log_prob, log_inclusion."""
    spark.conf.set(BATCH_CONF, BATCH_ROWS)
    return piece_sampling.encode_samples(docs, kept_edges=KEPT_EDGES)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact),
    ("near dedup", near),
    ("source mixing", mix),
    ("sentencepiece encoding", encode),
]

#: Two stages (a fitted classifier, sampled segmentations) have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), spark.conf.get(BATCH_CONF)
    try:
        for name, stage in STAGES:
            docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    finally:
        spark.conf.set(BATCH_CONF, before)
    return docs
