import zlib

import numpy as np

from odd_tables import none, odd, odd_labels, words  # noqa: F401
from tapework.llm import quality
from tapework.llm.features import Described, Encoder, describe, join_described, sample_labelled
import pyarrow as pa

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.score(docs, quality.train(docs, labels)).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    judged = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(judged) > 50 and np.mean([a == b for a, b in judged]) > 0.93


def test_pairwise_sum_in_linear_time():
    random = np.random.default_rng(0)
    sample = describe(pa.array(["a b c d a", "b c e", "Some Words! here", ""] * 3))
    model = quality.FactorisationMachine(Encoder(sample, least_texts=1))
    model.w, model.v = random.normal(size=model.w.shape), random.normal(size=model.v.shape)
    index, value, per = model.encoder.rows(sample)
    ends = np.cumsum(per)
    margin, _ = model._margin(index, value, per)
    for k, end in enumerate(ends):
        i, x = index[end - per[k]:end], value[end - per[k]:end]
        pairs = sum(model.v[i[a]] @ model.v[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a + 1, len(i)))
        assert np.isclose(margin[k], model.bias + model.w[i] @ x + pairs)


def test_described_parts_join():
    texts = pa.array(["The the THE, end.\nThe", None, "### ---", "x " * 50])
    d = describe(texts)
    assert d.lengths.tolist() == [2, 0, 0, 1] and sorted(d.counts[:2].tolist()) == [1, 4] and not d.stats[1].any()
    again = join_described([describe(texts.slice(k, 1)) for k in range(4)])
    assert isinstance(again, Described) and all((getattr(d, x) == getattr(again, x)).all() for x in ("buckets", "counts", "lengths"))
    assert np.allclose(d.stats, again.stats)


def test_odd_rows(odd, none, odd_labels):
    model = quality.train(odd, odd_labels)
    got = quality.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3, 4)}) == 1
    assert not [r for r in got if r.doc_id is None and r.held_out]
    kept = quality.keep_good(odd, model, least=0.0)
    assert kept.schema == odd.schema and kept.count() == odd.count()
    for untrained in (quality.train(odd, odd_labels.limit(0)), quality.train(none, odd_labels)):
        assert {r.score for r in quality.score(odd, untrained).collect()} == {0.5}
    assert quality.score(none, model).collect() == []


def test_one_text_per_labelled_id(spark):
    rows = [(1, f"text {k}") for k in range(300)] + [(1, None), (2, "one two"), (2, "one two"), (3, None), (4, "no label")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    label, described = sample_labelled(docs, labels, "quality", 10)
    assert label.tolist() == [1, 0, 1] and len(described) == 3


def test_a_sample_leaves_nothing_with_arrow(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    before = pa.total_allocated_bytes()
    y, described = sample_labelled(docs, labels, "quality", 200)
    assert len(y) == len(described) == 200 and pa.total_allocated_bytes() <= before
