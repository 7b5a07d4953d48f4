"""Historical event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line.

    The reader binds columns by position, so a header in another order is an
    error rather than silently wrong columns.
    """
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One JSON object per line; ``path`` may be a glob."""
    return spark.read.schema(schema).json(path)
