"""The bounded sample that models are fitted on, and slices of texts."""

from __future__ import annotations

import pyarrow as pa

from ridelake.llm.common import labelled_sample, slices


def test_sample_is_bounded_and_depends_on_the_ids_alone(spark):
    rows = [(k, f"text {k}", "rare" if k % 50 == 0 else "often") for k in range(3000)]
    rows += [(3, "text 3", "often")] * 2000 + [(None, "x", "often"), (7000, "x", None), (7001, None, "rare"), (7002, "y" * 99, "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    sample = labelled_sample(docs, docs, 40, longest=50)
    by_label = {label: [text for own, text in sample if own == label] for label in ("rare", "often")}
    assert {label: len(texts) for label, texts in by_label.items()} == {"rare": 40, "often": 40}
    assert all(len(set(texts)) == 40 for texts in by_label.values())
    assert sample == labelled_sample(docs.repartition(7), docs.repartition(3, "text"), 40, longest=50)
    assert len(labelled_sample(docs, docs, 10_000, longest=50)) == 3000
    assert labelled_sample(docs.filter("false"), docs, 5) == labelled_sample(docs, docs.filter("false"), 5) == []


def test_slices():
    texts = ["a" * 10, None, "", "b" * 100, "c", "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(6))], ["text", "n"])
    for batches in ([batch, batch.slice(0, 0)], [batch.slice(k, 1) for k in range(6)], [batch.slice(0, 4), batch.slice(4)]):
        cut = list(slices(iter(batches), "text", 20))
        assert [x for part in cut for x in part.column("text").to_pylist()] == texts
        assert [part.num_rows for part in cut] == [3, 1, 2]
    assert list(slices(iter([batch.slice(0, 0)]), "text")) == list(slices(iter([]), "text")) == []
    assert [part.num_rows for part in slices(iter([batch, batch]), "text")] == [12]
