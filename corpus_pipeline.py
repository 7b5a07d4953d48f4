"""A training corpus out of documents: stages of operators of ``ridelake.llm``, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import decontaminate, mixing, quality_neighbours, secret_crf, simhash_dedup
from ridelake.llm.common import free_names, shared_folder, table
from ridelake.llm.queries import LEAST_QUALITY
from ridelake.sources import storage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_neighbours.fit_labels(docs, table(spark, sf_dir, "labels"))
    return quality_neighbours.accepted(docs, model, spark, LEAST_QUALITY)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash_dedup.first_of_each(docs)


def keep_clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"), spark)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in them replaced by a mark; n_chars is counted again where the length changed."""
    (before,) = free_names(docs, "_chars")
    measured = docs.withColumn(before, F.length("text"))
    clean = secret_crf.redacted(measured, secret_crf.fit_documents(docs), spark)
    changed = F.length("text") != F.col(before)
    counted = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", counted).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for every time a document is taken, with its shard and epoch."""
    return mixing.mixture(docs, spark)


STAGES = [
    ("quality_classifier", keep_good),
    ("simhash_dedup", keep_one_of_each),
    ("benchmark_decontamination", keep_clean_of_benchmarks),
    ("secret_scan", hide_secrets),
    ("mixing", mix),
]

#: The classifier, the fields and the components can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; between them tables in the folder that all executors share."""
    docs = table(spark, sf_dir, "documents")
    root = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4()}"
    storage.delete_on_exit(spark, root)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
