"""Data quality checks and row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridelake.functions.schema import validate_schema


def check_data_quality(
    df: DataFrame,
    table_name: str,
    schema: StructType,
    key: str | None = None,
) -> DataFrame:
    """One row per check: (table_name, check_name, column_name, violations, passed).

    ``not_null`` for each column the schema requires, ``unique`` for ``key``
    (surplus rows per non-NULL key), ``schema`` for the frame's columns and types.
    All counts come from one pass over the data.
    """
    present = set(df.columns)
    required = [field.name for field in schema.fields if not field.nullable and field.name in present]
    counts = [("not_null", name, F.count_if(F.col(name).isNull())) for name in required]
    if key is not None:
        counts.append(("unique", key, F.count(key) - F.count_distinct(key)))
    counts.append(("schema", None, F.lit(0 if validate_schema(df, schema) else 1).cast("bigint")))

    totals = df.agg(*[total.alias(f"n{i}") for i, (_, _, total) in enumerate(counts)])
    rows = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(column).cast("string").alias("column_name"),
            F.col(f"n{i}").alias("violations"),
        )
        for i, (check, column, _) in enumerate(counts)
    ]
    checks = totals.select(F.inline(F.array(*rows)))
    return checks.select(
        F.lit(table_name).alias("table_name"), "*", (F.col("violations") == 0).alias("passed")
    )


def row_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    """(dataset, row_count) of each named frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("dataset"), "row_count")
        for name, df in datasets.items()
    ]
    union = counts[0]
    for other in counts[1:]:
        union = union.unionByName(other)
    return union


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and an observation that holds its ``row_count`` once it was written.

    The count is taken while the rows pass by, so nothing runs twice.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen
