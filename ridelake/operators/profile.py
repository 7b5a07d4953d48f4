"""Profiles of columns that can be merged: checks of a growing table read its new part only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Of an HLL sketch: 2^12 registers, 4 KB at most; the estimate's standard error is 1.04 / 2^6, 1.6 %.
LOG_REGISTERS = 12
#: Of a KLL sketch: ranks are within 1.7 % with 99 % probability.
QUANTILE_SIZE = 200


def profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A row for each group and column: (*by, column_name, row_count, nulls, distinct_sketch, quantile_sketch).

    One pass and one shuffle of a few KB a group, column and task. Quantiles are of numbers; other columns have a
    null sketch. Write it with the day as ``by``, day by day, and merge what days are asked for. NULLs of ``by`` are
    a group of their own; a table without rows gives none, or without ``by`` a row of zeros for each column.
    """
    parts = []
    for i, name in enumerate(columns):
        column = F.col(f"`{name}`")
        numeric = isinstance(df.schema[name].dataType, NumericType)
        quantiles = F.kll_sketch_agg_double(column.cast("double"), QUANTILE_SIZE) if numeric else F.lit(None)
        parts.append(F.count_if(column.isNull()).alias(f"_nulls{i}"))
        parts.append(F.hll_sketch_agg(column.cast("string"), LOG_REGISTERS).alias(f"_distinct{i}"))
        parts.append(F.max(quantiles).alias(f"_quantiles{i}") if not numeric else quantiles.alias(f"_quantiles{i}"))
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *parts)
    each = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("row_count"),
            F.col(f"_nulls{i}").alias("nulls"),
            F.col(f"_distinct{i}").alias("distinct_sketch"),
            F.col(f"_quantiles{i}").cast("binary").alias("quantile_sketch"),
        )
        for i, name in enumerate(columns)
    ]
    return groups.select(*by, F.inline(F.array(*each)))


def merged(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles put together, over all groups or those of ``by``; as if the rows had been profiled at once."""
    return profiles.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch", QUANTILE_SIZE).alias("quantile_sketch"),
    )


def report(profiles: DataFrame, shares: Sequence[float] = (0.01, 0.5, 0.99)) -> DataFrame:
    """The profiles with ``distinct_values`` (estimated) and ``quantiles`` (null but for numbers) for the sketches."""
    distinct = F.hll_sketch_estimate("distinct_sketch").alias("distinct_values")
    kept = [name for name in profiles.columns if name not in ("distinct_sketch", "quantile_sketch")]
    return profiles.select(*kept, distinct, _quantiles(shares).alias("quantiles"))


def _quantiles(shares: Sequence[float]) -> Column:
    sketch = F.col("quantile_sketch")
    some = sketch.isNotNull() & (F.kll_sketch_get_n_double(sketch) > 0)
    return F.when(some, F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(s)) for s in shares])))
