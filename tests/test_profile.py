"""Merged profiles are as near to exact values as one profile of all rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridelake.operators.profile import merged, profile, report


def test_profiles_of_days_merge_within_their_error(spark):
    df = spark.range(60_000).selectExpr(
        "CAST(id % 30 AS INT) AS day",
        "CAST(xxhash64(id % 20000) AS STRING) AS who",
        "IF(id % 10 = 0, NULL, sqrt(id)) AS fare",
    )
    days = profile(df, ["who", "fare"], by=["day"]).cache()
    assert days.count() == 60
    got = {r.column_name: r for r in report(merged(days), [0.1, 0.5, 0.9]).collect()}
    assert [got[c].row_count for c in ("who", "fare")] == [60_000, 60_000]
    assert [got[c].nulls for c in ("who", "fare")] == [0, 6_000]
    assert got["who"].distinct_values == pytest.approx(20_000, rel=0.08)
    assert got["fare"].distinct_values == pytest.approx(54_000, rel=0.08)
    assert got["who"].quantiles is None
    fares = np.sort([r.fare for r in df.filter("fare IS NOT NULL").select("fare").collect()])
    for share, value in zip((0.1, 0.5, 0.9), got["fare"].quantiles, strict=True):
        assert abs(np.searchsorted(fares, value) / len(fares) - share) < 0.035
    three = report(merged(days.filter("day < 3"))).filter("column_name = 'who'").first()
    exact = df.filter("day < 3").agg(F.count_distinct("who")).first()[0]
    assert three.distinct_values == pytest.approx(exact, rel=0.08) and three.row_count == 6_000


def test_empty_tables_nulls_and_odd_names(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "`a.b` double, day int")
    row = report(merged(profile(df, ["a.b"], by=["day"]))).first()
    assert (row.column_name, row.row_count, row.nulls, row.distinct_values, row.quantiles) == ("a.b", 2, 2, 0, None)
    assert profile(df.limit(0), ["a.b"], by=["day"]).count() == 0
    none = report(profile(df.limit(0), ["a.b", "day"])).collect()
    assert [(r.row_count, r.nulls, r.distinct_values, r.quantiles) for r in none] == [(0, 0, 0, None)] * 2
