"""Marts continued day by day, corrected late and published in one step, against full rebuilds."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from tapework.operators import indicators, resume
from tapework.operators.dimensions import company_keys, dim_calendar
from tapework.plans import loads, reports
from tapework.plans.refresh import SHOWN, refresh
from tapework.schemas import DIVIDENDS, QUOTES
from tapework.sinks import versions
from tapework.sources.generated import calendar_days

FIRST, LAST = dt.date(2022, 11, 1), dt.date(2023, 12, 31)


@pytest.fixture(scope="module")
def market(spark):
    """Bars of three tickers on most days, with a bad tick, and a few dividends."""
    rng, quotes, dividends = random.Random(2), [], []
    for k, ticker in enumerate(("AAA3", "BBB4", "CCC5")):
        price, day = 20.0 + k, FIRST
        while day <= LAST:
            if rng.random() < 0.9:
                price = round(max(1.0, price * rng.uniform(0.95, 1.055)), 2)
                quotes.append((day, ticker, price, price + 1, price - 0.5, price, price * 0.9, None if rng.random() < 0.1 else rng.randrange(999)))
                if rng.random() < 0.02:
                    dividends.append((day, ticker, round(rng.uniform(0.1, 2), 2)))
            day += dt.timedelta(1)
    return spark.createDataFrame(quotes, QUOTES).persist(), spark.createDataFrame(dividends, DIVIDENDS).persist()


@pytest.fixture(scope="module")
def make(spark, tmp_path_factory, market):
    """make(name, tickers, last): a run with its raw layer loaded up to ``last``."""
    tmp_path = tmp_path_factory.mktemp("runs")

    def made(name, tickers=("AAA3", "BBB4", "CCC5"), last=LAST):
        seed = tmp_path / f"{name}.csv"
        seed.write_text("ticker,nome,setor,subsetor,segmento\n" + "".join(f"{t},n,s,t,u\n" for t in tickers))
        run = loads.DailyRun(str(tmp_path / name), str(seed), ["AAA3", "BBB4", "CCC5"], FIRST, LAST, "month", (f"st_{name}", f"ma_{name}"), f"raw_{name}")
        loads.load_quotes(market[0], run.quotes_path, "range", last, FIRST, last, "month")
        loads.load_dividends(market[1], run.dividends_path, "inicial", last)
        return run
    return made


@pytest.fixture(scope="module")
def whole(spark, make):
    """All history refreshed at once; tests only read it."""
    run = make("whole")
    refresh(spark, run)
    return run


def shown(spark, run):
    return {name: spark.newSession().table(f"{run.layers[1]}.{name}") for name in SHOWN}


def assert_same_marts(spark, run, other):
    got, want = shown(spark, run), shown(spark, other)
    for name in SHOWN:
        a, b = got[name], want[name]
        if name == "mart_indicadores_resumo":  # means of means: the order of years may differ in the last digit
            a, b = (x.withColumns({c: F.round(c, 12) for c in ("volatilidade_media_30d", "retorno_medio_diario")}) for x in (a, b))
        assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_continued_days_equal_a_full_rebuild(spark, make, market, whole):
    run = make("days", last=dt.date(2023, 12, 20))
    refresh(spark, run)
    state_of = versions.Store(spark, f"{run.root}/marts", run.layers[1])
    for day in (21, 22):
        loads.run_daily(spark, run, *market, dt.date(2023, 12, day))
    loads.run_range(spark, run, market[0], dt.date(2023, 12, 23), LAST)
    assert state_of.manifest().version == 4
    assert_same_marts(spark, run, whole)
    # only the newest folder holds the last days: the earlier rows were not written again
    parts = state_of.manifest().tables["mart_indicadores_diarios"].parts
    assert sorted(p.last for p in parts if p.year == 2023)[0] == 20231220 and len([p for p in parts if p.year == 2023]) == 4


def test_late_correction_and_changed_dividend(spark, make, market):
    run = make("late")
    refresh(spark, run)
    start, end = dt.date(2023, 3, 1), dt.date(2023, 3, 9)
    doubled = market[0].withColumns({c: F.col(c) * 2 for c in QUOTES.names[2:7]})
    twice = market[1].withColumn("valor_dividendo", F.when(F.year("data_ex") == 2023, F.col("valor_dividendo") * 2).otherwise(F.col("valor_dividendo")))
    loads.load_dividends(twice, run.dividends_path, "incremental", LAST)
    loads.run_range(spark, run, doubled, start, end)
    whole = make("late_whole")
    loads.load_dividends(twice, whole.dividends_path, "incremental", LAST)
    loads.load_quotes(doubled, whole.quotes_path, "range", end, start, end, "month")
    refresh(spark, whole)
    assert_same_marts(spark, run, whole)


def test_new_company_brings_its_history_and_moves_no_key(spark, make, whole):
    run = make("fresh", ("BBB4", "CCC5"), dt.date(2023, 11, 30))
    refresh(spark, run)
    before = {r.ticker: r.empresa_id for r in spark.table(f"{run.layers[1]}.dim_empresa").collect()}
    later = make("fresh", ("AAA3", "BBB4", "CCC5"))
    refresh(spark, later, dt.date(2023, 12, 1))
    after = {r.ticker: r.empresa_id for r in spark.newSession().table(f"{run.layers[1]}.dim_empresa").collect()}
    assert before == {"BBB4": 1, "CCC5": 2} and after == {**before, "AAA3": 3}
    ids = spark.createDataFrame([(1, 3), (2, 1), (3, 2)], "empresa_id long, id long")
    for name in SHOWN[2:]:
        got = spark.newSession().table(f"{run.layers[1]}.{name}")
        want = spark.table(f"{whole.layers[1]}.{name}").join(ids, "empresa_id").withColumn("empresa_id", F.col("id")).select(got.columns)
        inexact = [c for c in ("volatilidade_media_30d", "retorno_medio_diario") if c in got.columns]
        got, want = (x.withColumns({c: F.round(c, 12) for c in inexact}) for x in (got, want))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), name
    loads.load_quotes(spark.createDataFrame([], QUOTES), run.quotes_path, "diario", LAST, granularity="month")
    refresh(spark, later, LAST)  # the state was built anew from the fact
    assert spark.newSession().table(f"{run.layers[1]}.mart_indicadores_diarios").count() == spark.table(f"{whole.layers[1]}.mart_indicadores_diarios").count()


def test_failed_and_killed_runs_change_nothing(spark, make, market, monkeypatch):
    run = make("safe")
    refresh(spark, run)
    seen = {name: df.collect() for name, df in shown(spark, run).items()}
    broken = market[0].withColumn("maxima", F.col("minima") - 1)
    with pytest.raises(RuntimeError, match="maxima_maior_igual_minima"):
        loads.run_range(spark, run, broken, dt.date(2023, 5, 1), dt.date(2023, 5, 9))
    loads.load_quotes(market[0], run.quotes_path, "range", LAST, dt.date(2023, 5, 1), dt.date(2023, 5, 9), "month")
    with monkeypatch.context() as m:
        m.setattr(versions.Store, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(spark, run, dt.date(2023, 5, 1))
    for name, df in shown(spark, run).items():
        assert sorted(df.collect(), key=repr) == sorted(seen[name], key=repr)
    store = versions.Store(spark, f"{run.root}/marts", run.layers[1])
    assert store.vacuum() and not store.vacuum()
    assert sorted(store.table("dim_empresa").collect(), key=repr) == sorted(seen["dim_empresa"], key=repr)


def test_two_runs_cannot_publish_the_same_version(spark, tmp_path):
    store = versions.Store(spark, str(tmp_path / "s"))
    one, two = store.manifest(), store.manifest()
    store.publish(one)
    with pytest.raises(Exception, match="exist"):
        store.publish(two)
    assert store.manifest().version == 1


def test_a_year_of_many_folders_is_folded(spark, make, market, monkeypatch, whole):
    monkeypatch.setattr("tapework.plans.refresh.FOLD_AFTER", 2)
    run = make("fold", last=dt.date(2023, 12, 29))
    refresh(spark, run)
    for day in (30, 31):
        loads.run_daily(spark, run, *market, dt.date(2023, 12, day))
    store = versions.Store(spark, f"{run.root}/marts", run.layers[1])
    assert len([p for p in store.manifest().tables["fato_cotacoes_diarias"].parts if p.year == 2023]) <= 2
    assert_same_marts(spark, run, whole)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_skip_years_and_exchanges(spark, whole):
    store = versions.Store(spark, f"{whole.root}/marts", whole.layers[1])
    daily, company = store.table("mart_indicadores_diarios"), store.table("dim_empresa")
    period = dt.date(2023, 2, 1), dt.date(2023, 6, 30)
    for report in (reports.risk_return(daily, company, *period), reports.period_returns(daily, company, *period),
                   reports.indicator_series(daily, company, "BBB4", *period)):
        assert "PartitionFilters: [isnotnull(ano_parte" in plan(report).replace("\n", " ")
    # sums by company, and joins of them and of the marts by company, follow the buckets
    yields = store.table("mart_dividend_yield")
    sums = daily.groupBy("empresa_id").agg(F.max("drawdown")).join(yields.groupBy("empresa_id").agg(F.max("dy_12m")).hint("merge"), "empresa_id")
    assert "Exchange" not in plan(sums) and sums.count() == 3
    both = daily.select("empresa_id", "drawdown").join(yields.groupBy("empresa_id").agg(F.max("dy_12m")).hint("merge"), "empresa_id")
    assert "Exchange" not in plan(both) and both.count() == daily.count()
    hot = versions.Store(spark, store.root, "ma_hot", max_bucket_rows=10)
    spark.sql("CREATE DATABASE ma_hot")
    assert "Exchange" in plan(hot.table("mart_indicadores_diarios").groupBy("empresa_id").count())
    files = daily.where("ano_parte = 2022").inputFiles()
    assert files and len(glob.glob(f"{store.root}/mart_indicadores_diarios/*/ano_parte=2022/*.parquet")) == len(files)


def test_state_keeps_the_last_sessions(spark):
    calendar = dim_calendar(calendar_days(spark, dt.date(2020, 1, 1), dt.date(2023, 12, 31))).persist()
    days = [r.tempo_id for r in calendar.orderBy("tempo_id").limit(700).collect()]
    fact = spark.createDataFrame([(k, d, float(10 + (i * 7919 + k) % 97), i) for k, n in ((1, 700), (2, 40), (3, 300)) for i, d in enumerate(days[:n])],
                                 "empresa_id long, tempo_id int, fechamento_ajustado double, volume long").persist()
    whole = indicators.daily_indicators(fact, calendar)
    for cut in (days[250], days[299], days[500]):
        old, new = fact.where(F.col("tempo_id") < cut), fact.where(F.col("tempo_id") >= cut)
        state = resume.state_after(old).persist()
        assert state.groupBy("empresa_id").count().agg(F.max("count")).first()[0] <= resume.HALO
        got, want = resume.continued_indicators(state, new, calendar), whole.where(F.col("tempo_id") >= cut)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        stepped = resume.state_after(new, state)
        assert stepped.exceptAll(resume.state_after(fact)).isEmpty() and resume.state_after(fact).exceptAll(stepped).isEmpty()


def test_keys_stay_when_tickers_come_and_go(spark):
    def tickers(*names):
        return spark.createDataFrame([(n,) for n in names], "ticker string")
    first = company_keys(tickers("B", "D"))
    second = company_keys(tickers("A", "C", "D"), first)
    assert sorted(tuple(r) for r in second.collect()) == [("A", 3), ("B", 1), ("C", 4), ("D", 2)]
    assert sorted(tuple(r) for r in company_keys(tickers(), second).collect()) == sorted(tuple(r) for r in second.collect())
