import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from odd_tables import none, odd, odd_labels, words  # noqa: F401
from tapework.llm import mixing
from tapework.session import stage_table


def table(spark, n=400, k=3, seed=0):
    random = np.random.default_rng(seed)
    p = random.dirichlet(np.full(k, 0.4), n)
    tokens = random.integers(0, 500, n)
    return p, tokens, spark.createDataFrame([(int(t), [float(x) for x in q]) for t, q in zip(tokens, p)], "n_tokens long, posterior array<double>").repartition(3)


@pytest.mark.parametrize("least", [0.0, 0.5])
def test_totals_match_targets(spark, least):
    p, tokens, df = table(spark)
    targets = {10: 0.5, 20: 0.3, 30: 0.2}
    rates = mixing.fit_rates(df, [10, 20, 30], targets, total=1.2, least=least)
    w = rates.final(p)
    totals = (w * tokens) @ p
    assert w.min() >= least and np.allclose(totals / tokens.sum() / 1.2, [0.5, 0.3, 0.2], atol=2e-3)


def test_out_of_reach_is_least_squares(spark):
    p, tokens, df = table(spark, 60, 2, 3)
    rates = mixing.fit_rates(df, [0, 1], {0: 1.0}, total=1.0)
    w, a = rates.final(p), tokens / tokens.sum()
    share = np.maximum(a @ p, 1e-9)

    def loss(w):
        return (((a * w) @ p - np.array([1.0, 0.0])) ** 2 / share).sum() + mixing.NEARNESS * (a * (w - 1) ** 2).sum()

    random = np.random.default_rng(1)
    best = loss(w)
    assert all(loss(np.maximum(w + random.normal(0, 0.05, len(w)), 0)) > best - 1e-4 for _ in range(300))


def solved(p, a, wanted, least, most):
    """Rates of the optimum by Newton steps on its multipliers: w = clip(1 - p u / NEARNESS), u the scaled residual."""
    share, u = np.maximum(a @ p, 1e-9), np.zeros(p.shape[1])

    def rates(u):
        return np.clip(1 - p @ u / mixing.NEARNESS, least, most)

    def gap(u):
        return share * u - (a * rates(u)) @ p + wanted

    for _ in range(200):
        w = rates(u)
        free = (w > least) & (w < most)
        slope = np.diag(share) + (p[free].T * a[free]) @ p[free] / mixing.NEARNESS
        way, size = np.linalg.solve(slope, gap(u)), 1.0
        while size > 1e-9 and np.linalg.norm(gap(u - size * way)) > np.linalg.norm(gap(u)):
            size /= 2
        u = u - size * way
    assert np.abs(gap(u)).max() < 1e-9
    return rates(u)


@pytest.mark.parametrize("targets,total,least,most", [
    ((0.2, 0.2, 0.6), 1.3, 0.5, 4.0), ((1.0, 0.0, 0.0), 1.0, 0.0, 2.0), ((0.0, 0.1, 0.9), 0.7, 0.2, 1.0)])
def test_rates_are_those_of_a_direct_solver(spark, targets, total, least, most):
    p, tokens, df = table(spark, 200, 3, 4)
    a, wanted = tokens / tokens.sum(), total * np.array(targets)
    w = mixing.fit_rates(df, [0, 1, 2], dict(enumerate(targets)), total=total, least=least, most=most).final(p)
    best, share = solved(p, a, wanted, least, most), a @ p

    def loss(w):
        return (((a * w) @ p - wanted) ** 2 / share).sum() + mixing.NEARNESS * (a * (w - 1) ** 2).sum()

    assert np.abs((a * w) @ p - (a * best) @ p).max() < 2e-3
    assert loss(best) - 1e-12 <= loss(w) <= loss(best) + 2e-5


def test_steps_are_the_same_however_often_rates_are_written(spark, monkeypatch):
    p, _, df = table(spark, 80, 3, 5)
    found = []
    for keep in (1, 7, 1000):  # the last writes nothing
        monkeypatch.setattr(mixing, "KEEP", keep)
        monkeypatch.setattr(mixing, "STEPS", 10)
        rates = mixing.fit_rates(df, [0, 1, 2], {0: 1.0}, total=1.0)
        assert len(rates.residuals) == 10
        found.append(rates.final(p))
    assert np.allclose(found[0], found[1], atol=1e-9) and np.allclose(found[1], found[2], atol=1e-9)


def test_a_step_is_one_job(spark, monkeypatch):
    _, _, df = table(spark, 80, 3, 5)
    df = stage_table(df, "steps")
    monkeypatch.setattr(mixing, "STEPS", 8)
    context = spark.sparkContext
    context.setJobGroup("steps", "steps")
    try:
        rates = mixing.fit_rates(df, [0, 1, 2], {0: 1.0}, total=1.0)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # one more for the totals before the first step
    assert len(rates.residuals) == 8 and len(context.statusTracker().getJobIdsForGroup("steps")) == 9


def test_totals_add_exactly_what_tasks_send(spark):
    rows = [(2**53, [1.0, 0.0]), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (0, [0.0, 1.0])]
    for order in (rows, rows[::-1], [rows[1], rows[0], rows[3], rows[2]]):
        df = spark.createDataFrame(spark.sparkContext.parallelize(order, 4), "n_tokens long, posterior array<double>")
        assert mixing._totals(df, [], lambda p: np.ones((len(p), 1)), 2).tolist() == [[2.0**53 + 2, 1.0]]
    assert mixing._totals(df.limit(0), [], lambda p: p, 2).tolist() == [[0.0, 0.0]]


def test_classifier_and_resampling(spark):
    docs, labels = (spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    model = mixing.train(docs, labels, "quality")
    got = mixing.mix(docs, model, {0: 0.5, 1: 0.5})
    rows = got.collect()
    assert len(rows) == docs.count()
    p, w, n = np.array([r.posterior for r in rows]), np.array([r.rate for r in rows]), np.array([r.n_tokens for r in rows])
    assert np.allclose(p.sum(1), 1) and np.allclose((w * n) @ p / n.sum(), 0.5, atol=5e-3)
    again = mixing.resample(docs, model, {0: 0.5, 1: 0.5})
    assert again.schema == docs.schema and abs(again.count() - w.sum()) < 4 * np.sqrt(len(w))


def test_odd_rows(odd, none, odd_labels):
    labelled = odd_labels.select("doc_id", (2 * F.col("quality") + F.col("toxic")).alias("domain"))
    model = mixing.train(odd, labelled, "domain")
    rows = mixing.mix(odd, model, {2: 0.7, 0: 0.3}).collect()
    assert len(rows) == odd.count() and all(r.rate >= 0 for r in rows)
    kept = mixing.resample(odd, model, {2: 0.7, 0: 0.3}, least=1.0, most=1.0)
    assert kept.schema == odd.schema and kept.exceptAll(odd).isEmpty() and kept.count() == odd.count()
    assert mixing.mix(none, model, {2: 1.0}).collect() == [] == mixing.resample(none, model, {2: 1.0}).collect()
    assert mixing.train(none, labelled, "domain") is None and mixing.train(odd, labelled.limit(0), "domain") is None
    assert {r.rate for r in mixing.mix(odd, None, {}).collect()} == {1.0} and mixing.resample(odd, None, {}).count() == odd.count()
