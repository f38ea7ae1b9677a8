import random
from collections import Counter

import numpy as np
import pytest

from odd_tables import none, odd, words  # noqa: F401
from tapework.llm import jaccard_join


def shingles(text):
    w = (text or "").split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(docs, threshold=0.8):
    """Sorted (doc_id, class_id, n_links) of all pairs of rows; rows without words are copies of each other."""
    sets, n = [shingles(t) for _, t in docs], len(docs)
    near = [[j for j in range(n) if j != i and (len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9 if sets[i] or sets[j] else True)]
            for i in range(n)]
    group = list(range(n))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(n):
        for j in near[i]:
            group[top(i)] = top(j)
    ids = {}
    for i in range(n):
        ids.setdefault(top(i), []).append(docs[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((docs[i][0], least[top(i)], len(near[i])) for i in range(n)), key=repr)


def joined(docs):
    return sorted((tuple(r) for r in jaccard_join.join(docs).collect()), key=repr)


def edited_copies(seed, groups, copies, length=120):
    rng = random.Random(seed)
    docs = []
    for g in range(groups):
        w = [f"g{g}w{rng.randrange(10**6)}" for _ in range(length)]
        for _ in range(copies):
            v = list(w)
            for _ in range(rng.randrange(5)):
                v[rng.randrange(length)] = f"x{rng.randrange(10**9)}"
            docs.append((len(docs), " ".join(v)))
    return docs


@pytest.mark.parametrize("blocks", [(512, 256), (4, 3)])
def test_links_are_those_of_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(jaccard_join, "BUCKET_BLOCK", blocks[0])
    monkeypatch.setattr(jaccard_join, "GROUP_BLOCK", blocks[1])
    docs = edited_copies(3, 12, 14)
    assert joined(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert joined(odd) == brute(rows)
    assert joined(none) == []


def test_one_row_of_each_class_stays(odd, none, spark):
    kept = jaccard_join.keep_one(odd)
    assert kept.schema == odd.schema
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    ids = [i for i, _ in got]
    assert ids.count(6) == 2 and 7 not in ids and 3 not in ids and ids.count(None) == 1 and ids.count(2) == 1
    assert jaccard_join.keep_one(none).collect() == []
    docs = edited_copies(5, 6, 9)
    kept = {r.doc_id for r in jaccard_join.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept == {c for _, c, _ in brute(docs)}


def changed(seed, groups, edits, length=204):
    """Pairs of texts of which the second has ``edits`` words replaced, far from each other: 5 shingles each."""
    rng, docs = random.Random(seed), []
    for g in range(groups):
        w = [f"g{g}w{rng.randrange(10**6)}" for _ in range(length)]
        v = list(w)
        for k in range(edits):
            v[10 + 40 * k] = f"x{rng.randrange(10**9)}"
        docs += [(len(docs), " ".join(w)), (len(docs) + 1, " ".join(v))]
    return docs


def nodes_of(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "xxhash64(text) AS key", "text")
    rows = df.mapInArrow(jaccard_join._signatures(5), "doc_id long, key long, node long, n long, labels array<long>")
    return rows.dropDuplicates(["node"]).cache()


def test_pairs_just_above_the_threshold_are_met(spark):
    docs = changed(7, 400, 4)  # 180 of 220 shingles: 0.818
    assert joined(spark.createDataFrame(docs, "doc_id long, text string")) == sorted(((i, i - i % 2, 1) for i in range(len(docs))), key=repr)


def test_prefixes_shorten_on_the_data(spark):
    assert jaccard_join.candidates(nodes_of(spark, changed(8, 30, 4)), 0.8)[1] == jaccard_join.shortest_prefix() == 5
    assert jaccard_join.candidates(nodes_of(spark, changed(8, 30, 1)), 0.8)[1] > 5
    recalls = [jaccard_join.estimated_recall({170: 3, 192: 10**6}, d) for d in range(8, 0, -1)]
    assert recalls == sorted(recalls) and recalls[0] < 0.9999 and jaccard_join.estimated_recall({}, 8) == 1
    assert jaccard_join.estimated_recall({192: 1}, 8) > jaccard_join.estimated_recall({192: 10**6, 160: 1}, 8)


@pytest.mark.parametrize("block", [512, 4])
def test_each_pair_is_met_once_at_its_longest_prefix(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BUCKET_BLOCK", block)
    nodes = nodes_of(spark, edited_copies(9, 5, 12))
    rows = [(r.node, np.array(r.labels).astype(">i8").view(np.uint8).reshape(24, 8)) for r in nodes.collect()]
    tries = nodes.selectExpr("node", "posexplode(labels) AS (tree, label)")
    least = 0.8 - jaccard_join.MARGIN * jaccard_join.deviation(0.8)
    for length in (8, 7, 5):
        met = jaccard_join._met(tries, nodes, length, 0.8)
        want = Counter()
        for i, (_, a) in enumerate(rows):
            for _, b in rows[:i]:
                if (a == b).mean() >= least and np.logical_and.accumulate(a == b, 1).sum(1).max() == length:
                    want[int((a == b).sum())] += 1
        got = {r.agree: r.n for r in met.where("agree IS NOT NULL").groupBy("agree").agg({"pairs": "sum"}).toDF("agree", "n").collect()}
        assert got == dict(want)


def test_shortest_prefix_reaches_the_target():
    assert jaccard_join.shortest_prefix(0.95) > jaccard_join.shortest_prefix(0.8) > jaccard_join.shortest_prefix(0.5)
    d = jaccard_join.shortest_prefix()
    assert jaccard_join.meets(0.8, d) >= jaccard_join.TARGET_RECALL > jaccard_join.meets(0.8, d + 1)
