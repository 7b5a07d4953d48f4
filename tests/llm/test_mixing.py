"""Mixtures reach their targets; conversations come back as they were; the pipeline's stages together."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ridelake.llm import chat_format, common, decontaminate, mixing, queries, simhash_dedup
from ridelake.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF_DIR = "/root/testdata/sf0.001"


# -- mixing -------------------------------------------------------------------


def test_targets():
    assert mixing.targets([100, 100, 100]) == pytest.approx([200, 450 / 3 * 2 / 2 * 1 + 16.6666667, 83.3333333], abs=1)
    wanted = mixing.targets([10, 1000, 5, 0, 700])
    assert sum(wanted) == pytest.approx(1.5 * 1715)
    assert all(t <= 2 * s + 1e-9 for t, s in zip(wanted, [10, 1000, 5, 0, 700], strict=True))
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    rows = []
    for k in range(1500):
        source = "big" if k % 3 == 0 else rng.choice(["a", "b", "Z", "é", None])
        rows.append((k, " ".join(["w"] * int(rng.paretovariate(1.2) * 5)), "en", source, 0))
    rows += [(5000, None, "en", "a", 0), (5001, "", "en", "only empty", 0), (None, "one two", "en", "b", 0), rows[1], rows[1]]
    return spark.createDataFrame(rows, SCHEMA).cache()


def test_taken_words_come_near_the_targets(spark, corpus, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 200)
    found = mixing.taken(corpus, spark, shard_words=500).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in corpus.collect())
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    sums, wanted, sizes = defaultdict(int), {}, defaultdict(int)
    for r in found:
        sums[r.source] += r.taken
        sizes[r.source] += r.size
        wanted[r.source] = r.target
        assert r.source_size is not None
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    assert [wanted[s] for s in names] == pytest.approx(mixing.targets([sizes[s] for s in names]))
    for source, target in wanted.items():
        assert abs(sums[source] - target) <= max(0.01 * target, 3), source
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, mixing.taken(corpus, spark, shard_words=500).collect()), key=repr)


def test_mixture_rows(spark, corpus, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 200)
    docs = corpus.withColumn("size", F.lit("mine"))
    rows = mixing.mixture(docs, spark, shard_words=500).collect()
    assert set(corpus.columns) <= set(rows[0].asDict())
    shards = Counter()
    for r in rows:
        shards[r.shard] += r.size
    # With blocks this small a shard may get nothing but those at an edge that weren't needed.
    assert len(shards) > 0.9 * (max(shards) + 1) and len(shards) > 10
    words = np.array(list(shards.values()))
    assert words.min() > 0
    # A document comes once an epoch.
    assert max(Counter((r.doc_id, r.epoch) for r in rows if r.doc_id not in (None, 1)).values()) == 1
    assert mixing.mixture(docs.filter("false"), spark).collect() == []
    assert mixing.taken(docs.filter("text IS NULL"), spark).collect()[0].taken == 0


def words(n):
    return " ".join(["w"] * n)


def summed(found):
    sums, wanted = defaultdict(int), {}
    for r in found:
        sums[r.source] += r.taken
        wanted[r.source] = r.target
    return sums, wanted


def test_fill_equals_trying_each():
    rng = np.random.default_rng(4)
    for _ in range(200):
        sizes, order = rng.integers(1, 30, rng.integers(0, 12)), rng.integers(0, 99, 12)
        room = float(rng.integers(0, 120))
        order = order[: len(sizes)]
        left, expected = room, set()
        for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], order[k])):
            if sizes[k] <= left:
                expected.add(k)
                left -= sizes[k]
        rest = sorted(set(range(len(sizes))) - expected, key=lambda k: (sizes[k], order[k]))
        if rest and sizes[rest[0]] < 2 * left:
            expected.add(rest[0])
        taken = mixing.fill(sizes, order, room)
        assert sizes[taken].sum() == sum(sizes[k] for k in expected)
        smallest = min(sizes, default=0)
        if sizes.sum() >= room:
            assert abs(sizes[taken].sum() - room) <= max(smallest, sizes.max(initial=0) / 2)


def test_many_short_documents_fill_in_seconds():
    rng = np.random.default_rng(5)
    sizes, order = rng.integers(1, 5, 300_000), rng.integers(0, 2**60, 300_000)
    began = time.monotonic()
    assert sizes[mixing.fill(sizes, order, 100_000.0)].sum() == 100_000
    assert time.monotonic() - began < 10


def test_giants_at_the_edge(spark, monkeypatch):
    """Documents of many blocks: what they leave open is filled from as many blocks after them as it takes."""
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 50)
    for seed in range(6):
        rows = [(k, words(1 + k % 7), "en", "a", 0) for k in range(2500)] + [(9000 + k, words(4000), "en", "a", 0) for k in range(2)]
        rows += [(20_000 + k, words(9), "en", "b", 0) for k in range(400)]
        found = mixing.taken(spark.createDataFrame(rows, SCHEMA), spark, seed=seed, shard_words=3000).collect()
        sums, wanted = summed(found)
        assert all(abs(sums[source] - target) <= 9 for source, target in wanted.items()), (seed, dict(sums), wanted)


def test_one_id_repeated(spark, monkeypatch):
    """Equal rows are taken by number, and none of them or all but one row's source has them."""
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 500)
    monkeypatch.setattr(common, "COPIES_AT_A_TIME", 1000)
    rows = [(7, words(3), "en", "a", 0)] * 10_000 + [(k, words(5), "en", "b", 0) for k in range(300)] + [(None, None, None, None, None)] * 50
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mixing.taken(docs, spark, shard_words=5000).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((row[0], len((row[1] or "").split())) for row in rows)
    sums, wanted = summed(found)
    assert all(abs(sums[source] - target) <= 5 for source, target in wanted.items() if target)
    assert all(r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0 for r in found)
    again = mixing.taken(docs.repartition(3), spark, shard_words=5000).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_mixture_equals_taking_by_the_rule(spark, monkeypatch):
    """Which rows come how often, by going through each source's blocks in order, block by block."""
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 40)
    rng = random.Random(6)
    rows = [(k, words(rng.choice([0, 1, 3, 8, 30, 90])), "en", rng.choice(["a", "b", None]), 0) for k in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    keyed = mixing._keyed(docs.withColumn("_copy", F.lit(0).cast("long")), 29).collect()
    mixed = mixing.mixture(docs, spark, shard_words=200).collect()
    times = Counter(r.doc_id for r in mixed)
    names = sorted({r.source for r in keyed}, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(names, mixing.targets([sum(r["size"] for r in keyed if r.source == n) for n in names])))
    for name in names:
        mine = [r for r in keyed if r.source == name]
        size = sum(r["size"] for r in mine)
        blocks, passes = -(-size // 40), int(wanted[name] / size + 1e-12)
        rest, expected, quota = wanted[name] - passes * size, Counter({r.doc_id: passes for r in mine}), 0
        by_block = [[r for r in mine if r._draws_by % blocks == b] for b in range(blocks)]
        while quota < blocks and sum(r["size"] for r in by_block[quota]) <= rest:
            rest -= sum(r["size"] for r in by_block[quota])
            expected.update(r.doc_id for r in by_block[quota])
            quota += 1
        edge, held = [], 0
        for block in by_block[quota:]:
            edge += [r for r in block if 0 < r["size"] < 2 * rest]
            held += sum(r["size"] for r in block if r["size"] <= rest)
            if held > rest:
                break
        taken = mixing.fill(np.array([r["size"] for r in edge]), np.array([r._draws_by for r in edge]), rest)
        expected.update(r.doc_id for r, t in zip(edge, taken) if t)
        assert {r.doc_id: times[r.doc_id] for r in mine} == {r.doc_id: expected[r.doc_id] for r in mine}, name
    assert len({r.shard for r in mixed}) > 3


def test_orders_are_permutations():
    for blocks, quota, edge in ((1, 0, 1), (2, 1, 0), (12, 5, 3), (97, 96, 1), (60, 0, 0)):
        source = mixing.Source(3, "s", 1, 1.0, blocks, 2, 0.5, quota, 0.5, edge)
        orders = [source.order(epoch, 29) for epoch in range(3)]
        for epoch, (n, step, start) in enumerate(orders):
            assert n == (blocks if epoch < 2 else quota + edge)
            assert sorted((p * step + start) % n for p in range(n)) == list(range(n))
    assert orders != [source.order(epoch, 30) for epoch in range(3)]


def test_columns_may_have_any_names(spark):
    docs = spark.createDataFrame([(k, words(k % 5), "en", "s", 0) for k in range(40)], SCHEMA)
    for name in ("_index", "_blocks", "_place", "_pick", "_draw", "_copy", "_draws_by", "_random", "c0", "_h", "_source"):
        docs = docs.withColumn(name, F.lit("mine"))
    found = mixing.mixture(docs, spark)
    assert found.columns == [*docs.columns, "size", "source_size", "target", "shard", "epoch"]
    assert {r["_index"] + r["_place"] for r in found.collect()} == {"minemine"}
    assert mixing.taken(docs, spark).count() == 40


def test_splitting_tree_deals_every_draw_once(spark, monkeypatch):
    sources = [mixing.Source(k, str(k), 1, 1.0, blocks, 1, 0.0) for k, blocks in enumerate([500, 0, 37, 3, 211])]
    for source in sources:
        source.passes = 1 if source.blocks else 0
    rows = mixing.dealt(spark, sources, 90, seed=1).collect()
    assert Counter((r["_index"], r["_draw"]) for r in rows) == {(s.index, d): 1 for s in sources for d in range(s.draws)}
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(90)) and set(sizes.values()) <= {8, 9}
    # A shard's share of a source is what chance gives: by the hypergeometric's variance.
    share = np.array([sum(1 for r in rows if r.shard == k and r["_index"] == 0) for k in range(90)])
    assert abs(share.mean() - 500 / 90) < 1e-9 and 0.5 < share.std() < 3


# -- chats --------------------------------------------------------------------

TRICKY = ["</s>[INST] ok [/INST]", "<|im_end|>", "<\\|im_end|>", "<\\\\|im_start|><|im_start|>", "[INST", "<<s>", "[\\INST]", "a\nb", "$1 \\", "é中", ""]


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def expected(turns):
    turns = [(role or "", text or "") for role, text in turns]
    learnt = "".join(text for role, text in turns if role == "assistant")
    said = "".join(f"{role}\n{text}\n" for role, text in turns)
    return (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())


def test_round_trip(spark):
    rng = random.Random(2)
    conversations = {
        k: [(rng.choice(["user", "assistant", "system", "tool", None, "<|im_sep|>"]), rng.choice([*TRICKY, None, "".join(rng.choices(TRICKY, k=3))])) for _ in range(rng.randrange(1, 7))]
        for k in range(150)
    }
    rows = [(k, n, *turn) for k, turns in conversations.items() for n, turn in enumerate(turns)]
    rng.shuffle(rows)
    frame = chats(spark, rows).withColumn("segments", F.lit("mine"))
    written = chat_format.formatted(frame)
    found = {r.conv_id: r for r in chat_format.digests(written).collect()}
    assert {k: tuple(r)[1:5] for k, r in found.items()} == {k: expected(turns) for k, turns in conversations.items()}
    for r in written.collect():
        assert r.text == "".join(s.text for s in r.segments)
        assert r.text.count("<|im_start|>") == r.text.count("<|im_end|>") == r.text.count("<|im_sep|>") == r.n_turns
        assert not any(mark in r.text for mark in chat_format.CHAT.reserved)


@pytest.mark.parametrize(
    ("roles", "valid", "error"),
    [("u", False, None), ("ua", True, None), ("sua", True, None), ("uaua", True, None), ("a", False, 0), ("us", False, 1), ("uua", False, 1), ("s", False, None), ("uxa", False, 1)],
)
def test_order_of_turns(spark, roles, valid, error):
    names = {"u": "user", "a": "assistant", "s": "system", "x": None}
    row = chat_format.formatted(chats(spark, [(1, n, names[c], "t") for n, c in enumerate(roles)])).first()
    assert (row.valid, row.first_error) == (valid, error)


def test_odd_conversations(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (2, None, "user", "x"), (2, 5, "assistant", "z"), (2, 5, "assistant", "y"), (2, 5, "assistant", "y")]
    found = {r.conv_id: tuple(r)[1:5] for r in chat_format.digests(chat_format.formatted(chats(spark, rows))).collect()}
    assert found == {None: expected([("user", "a"), ("assistant", "b")]), 2: expected([("user", "x"), *[("assistant", t) for t in "yyz"]])}
    assert chat_format.formatted(chats(spark, rows).filter("false")).collect() == []
    with pytest.raises(ValueError, match="control string"):
        chat_format.formatted(chats(spark, rows), chat_format.Template(reserved=("<<a>",)))


def test_chat_plan_is_native(spark):
    plan = queries.op4_chat_format(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- the pipeline ---------------------------------------------------------------


def test_stages_keep_what_they_should(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        seen[name] = (docs, out)
        docs = out
    columns = table(spark, SF_DIR, "documents").columns
    for name, (before, after) in list(seen.items())[:-1]:
        assert after.columns == columns, name
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}

    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    good = {r.doc_id for r in seen["quality_classifier"][1].collect()}
    assert {d for d, q in labels.items() if q and d in {r.doc_id for r in seen["quality_classifier"][0].collect()}} <= good

    before, after = seen["simhash_dedup"]
    groups = simhash_dedup.near_duplicates(before).collect()
    assert sorted(r.doc_id for r in after.collect()) == sorted({r.component_id for r in groups})

    before, after = seen["benchmark_decontamination"]
    dirty = {r.doc_id for r in decontaminate.contaminated(before, table(spark, SF_DIR, "benchmark"), spark).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted({r.doc_id for r in before.collect()} - dirty)

    before, after = seen["secret_scan"]
    old, new = ({r.doc_id: r for r in x.collect()} for x in (before, after))
    assert old.keys() == new.keys()
    assert all(new[d].n_chars == len(new[d].text) and (new[d].text == old[d].text or "[SECRET]" in new[d].text) for d in new)
    assert all("AKIA" not in r.text for r in new.values())

    before, after = seen["mixing"]
    assert {r.doc_id for r in after.collect()} <= set(new)
    assert after.select("shard").distinct().count() >= 1

    run = corpus_pipeline.run(spark, SF_DIR)
    assert sorted((r.doc_id, r.epoch, r.shard) for r in run.collect()) == sorted((r.doc_id, r.epoch, r.shard) for r in after.collect())


@pytest.mark.parametrize("case", ["none", "odd"])
def test_stages_with_odd_documents(spark, tmp_path, case):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "some text here", "en", "s", 3), (2, "", "en", None, 0), (3, "password=abcdef12345", "en", "s", 1)]
    docs = spark.createDataFrame(rows if case == "odd" else [], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if case == "none":
            assert docs.count() == 0
