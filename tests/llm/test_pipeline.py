import os

import corpus_pipeline as pipeline
from conftest import SMALL
from odd_tables import none, odd, odd_labels, words  # noqa: F401
from tapework.llm import jaccard_join, packing, quality, secrets
from tapework.llm.common import components
from tapework.session import stage_table


def test_stages_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "secret scans", "mixing sources to target weights", "packing"]


def test_each_stage_decides_about_all_it_gets(spark):
    docs, sets = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in pipeline.STAGES[:-1]:
        kept = stage_table(stage(spark, docs, SMALL), "stage")
        assert kept.schema.simpleString() == docs.schema.simpleString()
        sets.append((name, docs, kept))
        docs = kept
    (_, docs, good), (_, _, single), (_, _, masked), (_, _, mixed) = sets
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    score = {r.doc_id: r.score for r in quality.score(docs, quality.train(docs, labels)).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, s in score.items() if s >= quality.KEEP}
    classes = {r.doc_id: r.class_id for r in jaccard_join.join(good).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(classes.values()))
    assert masked.count() == single.count() and not [r for r in secrets.scan(masked, None).collect() if r.spans]
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in masked.collect()}
    assert packing.pack_documents(mixed).count() == mixed.count()


def test_run(spark):
    rows = pipeline.run(spark, SMALL).collect()
    assert rows and len({(r.bucket, r.batch, r.row_in_batch) for r in rows}) == len(rows)


def test_odd_and_empty_tables_pass_all_stages(spark, odd, none, odd_labels, tmp_path):
    odd_labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs, rows in ((odd, odd.count()), (none, 0)):
        for _, stage in pipeline.STAGES[:-1]:
            docs = stage_table(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.columns == odd.columns and docs.select("doc_id").distinct().count() <= rows
        assert pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_staged_tables_have_no_success_marker(spark):
    table = stage_table(spark.range(10).repartition(2), "unmarked")
    assert "_SUCCESS" not in os.listdir(table.staged_at.removeprefix("file:")) and table.count() == 10


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000), (2000, 1999), (1999, 1998)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{i: 1998 for i in range(1998, 2001)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
