"""Places against a plain walk of the same network, and what the law says."""

from __future__ import annotations

import struct
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from ridelake.llm import feistel_sharding as sharding

DOCS = "doc_id long, text string, lang string"


def hashed(*values):
    """Spark's xxhash64 of longs and ints: each value's hash is the seed of the next."""
    seed = 42
    for value, size in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q" if size == 8 else "<i", value), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain(number, n, seed):
    a, b = sharding.radices(n)
    while True:
        left, right = number % a, number // a
        for turn in range(sharding.ROUNDS):
            if turn % 2 == 0:
                left = (left + hashed((right, 8), (turn, 4), (seed, 4)) % a) % a
            else:
                right = (right + hashed((left, 8), (turn, 4), (seed, 4)) % b) % b
        number = right * a + left
        if number < n:
            return number


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 31, 97, 1009])
def test_permutation_equals_a_plain_walk(spark, n, monkeypatch):
    def beyond(n):
        """Digits with much room beyond n, so that many numbers walk."""
        return 1 + n // 2, 3

    for choose in (sharding.radices, beyond):
        monkeypatch.setattr(sharding, "radices", choose)
        places = spark.range(n).select("id", sharding.permuted(F.col("id"), n, 5).alias("p"))
        back = places.select("id", "p", sharding.row_at(F.col("p") % 3, F.expr("p div 3"), n, 3, 5).alias("row"))
        found = {r["id"]: r["p"] for r in back.collect()}
        assert found == {k: plain(k, n, 5) for k in range(n)}
        assert sorted(found.values()) == list(range(n))
        assert all(r["row"] == r["id"] for r in back.collect())


def test_radices():
    for n in [*range(1, 3000), 10**6 + 3, 10**11 + 7]:
        a, b = sharding.radices(n)
        assert n <= a * b < n + a and a <= 2 * n**0.5 + 2
    a, b = sharding.radices(10**11 + 7)
    assert a * b - (10**11 + 7) < 8


def places(spark, rows, **options):
    docs = spark.createDataFrame(rows, DOCS).withColumn("_h", F.lit(1)).withColumn("shard", F.lit("mine"))
    return sharding.sharded(docs, **options)


def test_law_of_rows(spark):
    rows = [(k % 700 if k % 5 else None, None if k % 11 == 0 else "é" * (k % 13), "x") for k in range(1000)]
    found = places(spark, rows, shards=7).collect()
    assert Counter((r["doc_id"], r["text"], r["lang"]) for r in found) == Counter(rows)
    counts = Counter(r["shard"] for r in found)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))
    for r in found:
        text = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 16, zlib.crc32(text), "rows", None)


def test_places_do_not_depend_on_the_layout(spark):
    rows = [(k, f"text {k % 40}", "x") for k in range(500)]

    def found(rows, parts):
        docs = spark.createDataFrame(rows, DOCS).repartition(parts)
        return {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.sharded(docs, 40).collect()}

    first = found(rows, 1)
    assert found(rows[::-1], 7) == first
    assert len(set(first.values())) == 500
    # Equal texts and neighbouring ids are spread.
    assert max(Counter(first[k][0] for k in range(0, 500, 40)).values()) < 6
    other = spark.createDataFrame(rows, DOCS)
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.sharded(other, 40, seed=1).collect()} != first


def test_equal_rows_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES_AT_A_TIME", 16)
    rows = [(None, None, None)] * 300 + [(k, "", None) for k in range(50)]
    found = places(spark, rows, shards=4).collect()
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter(row[:2] for row in rows)
    assert sorted((r["shard"], r["slot"]) for r in found) == sorted((k % 4, k // 4) for k in range(350))


def test_nothing_few_and_maps(spark):
    assert places(spark, []).collect() == []
    assert [(r["shard"], r["slot"]) for r in places(spark, [(1, "a", "x")]).collect()] == [(0, 0)]
    docs = spark.createDataFrame([(1, "a", "x")] * 3, DOCS).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    assert {r["shard"] for r in sharding.sharded(docs).collect()} == {0, 1, 2}
    with pytest.raises(ValueError, match="a shard"):
        sharding.sharded(docs, 0)


def test_no_python_in_the_plan(spark):
    plan = places(spark, [(1, "a", "x")])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_written_shards(spark, tmp_path):
    rows = [(k, "t", "x") for k in range(90)]
    docs = spark.createDataFrame(rows, DOCS)
    sharding.write_shards(sharding.sharded(docs, 4), str(tmp_path / "out"))
    read = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(r["shard"] for r in read.collect()) == {0: 23, 1: 23, 2: 22, 3: 22}
    one = [r["slot"] for r in spark.read.parquet(str(tmp_path / "out" / "shard=0")).collect()]
    assert sorted(one) == list(range(23))
