"""The audit against going through every order filter by filter."""

from __future__ import annotations

import random
import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from ridelake.llm import filter_audit

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    found = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found.append(
            {
                "A": len(words) < 200,
                "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                "D": bool(re.search(r"[#$%&*|]", text)),
                "E": doc_id is not None and doc_id > least[text],
            }
        )
    return found


def brute(rows, labels):
    good = {i for i, quality, _ in labels if i is not None and quality == 1}
    bad = {i for i, _, toxic in labels if i is not None and toxic == 1}
    out = {}
    fails = failures(rows)
    for part in {source or "" for _, _, source in rows}:
        mine = [(i, f) for (i, _, source), f in zip(rows, fails) if (source or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[letter]]
                left = [(i, f) for i, f in left if not f[letter]]
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(f[letter] for _, f in mine) - len(gone),
                    sum(f[letter] and sum(f.values()) == 1 for _, f in mine),
                    sum(i in good for i, _ in gone),
                    sum(i in bad for i, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {key: tuple(row) for key, row in out.items()}


def found(spark, rows, labels):
    docs = spark.createDataFrame(rows, DOCS).withColumn("part", F.lit("mine")).withColumn("mask", F.lit(7))
    result = filter_audit.filter_audit(docs, spark.createDataFrame(labels, LABELS).withColumn("good", F.lit(0)))
    return {(r[0], r[1], r[2]): tuple(r[3:]) for r in result.collect()}


def test_ranks_are_places():
    orders = list(map("".join, permutations("ABCDE")))
    assert filter_audit.ORDERS == sorted(orders)
    assert [filter_audit.rank(order) for order in orders] == list(range(120))
    assert filter_audit.rank("BA") == 24 and filter_audit.rank("") == 0


def test_intervals_are_the_orders_that_remove():
    for mask in range(1, 32):
        rows = [row for row in filter_audit.intervals().tolist() if row[0] == mask]
        removal = np.full(120, -1)
        for _, step, first, end in rows:
            assert (removal[first:end] == -1).all()
            removal[first:end] = step
        letters = [x for k, x in enumerate("ABCDE") if mask >> k & 1]
        assert removal.tolist() == [min(order.index(x) for x in letters) for order in filter_audit.ORDERS]


def random_rows(rng, n):
    words = ["a", "b", "Cc", "d#", "e", "ü"]
    texts = [None, "", "A", " \n", "x $", "same text here"] + [
        " ".join(rng.choices(words if rng.random() < 0.5 else list(map(str, range(400))), k=rng.choice([3, 150, 250])))
        for _ in range(n // 4)
    ]
    ids = [None, *range(n)]
    return [(rng.choice(ids), rng.choice(texts), rng.choice([None, "", "s", "t"])) for _ in range(n)]


def test_audit_equals_every_order(spark):
    rng = random.Random(3)
    for n in (1, 12, 60):
        rows = random_rows(rng, n)
        labels = [(rng.choice([None, *range(n)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(n)]
        assert found(spark, rows, labels) == brute(rows, labels)


def test_nothing(spark):
    assert found(spark, [], []) == {}
    rows = [(1, "word " * 300, "s")]
    assert found(spark, rows, []) == brute(rows, [])


def test_copies_are_counted_without_meeting(spark):
    """A third of the rows are copies of one text; a text's groups are one for each part and label."""
    rows = [(k, "copy" if k % 3 else f"own {k}", "ab"[k % 2]) for k in range(3000)]
    result = filter_audit.counted(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS))
    copies = {r["part"]: r["n"] for r in result.collect() if r["mask"] & 16}
    assert copies == {"a": 1000, "b": 999}


def test_very_long_text(spark):
    text = "Word# " * 1_000_000
    rows = [(2, text, None), (1, text, None), (3, "w" * 3_000_000, None)]
    assert found(spark, rows, [(2, 1, 1)]) == brute(rows, [(2, 1, 1)])
