import datetime as dt
import math

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tapework.functions import scalar
from tapework.functions.aggregates import arg_max, arg_min
from tapework.operators import facts, layout, quality, sets
from tapework.plans import exploratory, reports
from tapework.schemas import RAW_QUOTES

DAY = dt.date(2020, 3, 2)
COMPANY = "empresa_id long, ticker string, nome string"


@pytest.fixture(scope="module")
def company(spark):
    return spark.createDataFrame([(1, "AAA", "a"), (2, "BBB", "b"), (3, "CCC", "c")], COMPANY)


@pytest.fixture(scope="module")
def daily(spark):
    rows = []
    for company, prices in ((1, [10.0, 12.0, 9.0, 18.0]), (2, [5.0, 5.0, 4.0, 8.0]), (3, [None, 3.0, 6.0, None])):
        for i, p in enumerate(prices):
            rows.append((company, DAY + dt.timedelta(i), p, 0.1 * (i + company) if i else None, None if i == 0 else 0.5))
    return spark.createDataFrame(
        rows, "empresa_id long, data date, fechamento_ajustado double, retorno_log double, retorno_simples double")


def test_period_returns_start_again_inside_the_period(daily, company):
    got = {(r.ticker, r.data): r for r in reports.period_returns(
        daily, company, DAY + dt.timedelta(1), DAY + dt.timedelta(3)).collect()}
    assert len(got) == 9
    assert got["AAA", DAY + dt.timedelta(1)].retorno_janela == 0
    last = got["AAA", DAY + dt.timedelta(3)]
    assert last.retorno_janela == 0.5 and last.base_100 == 150
    assert all(r.base_100 == pytest.approx(100 * (1 + r.retorno_janela))
               for r in got.values() if r.retorno_janela is not None)


def test_risk_return_uses_first_and_last_known_price(daily, company):
    got = {r.ticker: r for r in reports.risk_return(daily, company, DAY, DAY + dt.timedelta(3)).collect()}
    assert got["CCC"].retorno_periodo == 1.0 and got["AAA"].retorno_periodo == pytest.approx(0.8)
    assert got["AAA"].volatilidade_periodo == pytest.approx(0.1 * math.sqrt(252))
    one = reports.risk_return(daily, company, DAY, DAY + dt.timedelta(1)).first()
    assert one.volatilidade_periodo is None


def test_arg_max_skips_null_values(daily):
    got = daily.where("empresa_id = 3").agg(
        arg_max(F.col("fechamento_ajustado"), F.col("data")), arg_min(F.col("fechamento_ajustado"), F.col("data"))).first()
    assert tuple(got) == (6.0, 3.0)


def test_period_start_clips_month_end_and_series_start(spark, company):
    rows = [(1, dt.date(2021, 1, 5)), (1, dt.date(2024, 8, 31)), (2, dt.date(2024, 8, 1)), (2, dt.date(2024, 8, 31))]
    got = {(r.ticker, r.periodo): r.inicio for r in reports.period_starts(
        spark.createDataFrame(rows, "empresa_id long, data date"), company).collect()}
    assert got["AAA", "6 meses"] == dt.date(2024, 2, 29) and got["AAA", "Tudo"] == dt.date(2021, 1, 5)
    assert got["BBB", "1 ano"] == dt.date(2024, 8, 1)


def test_best_and_worst(spark):
    table = spark.createDataFrame(
        [("A", 0.5, -0.1, 0.3, 0.0), ("B", 0.1, -0.6, 0.2, 0.0), ("C", None, -0.3, 0.9, 0.0)],
        "ticker string, retorno_acumulado_total double, max_drawdown double, volatilidade_media_30d double, dy_atual double")
    got = {(r.ticker, r.metrica): r.marca for r in reports.best_worst_flags(table).collect()}
    assert got["A", "retorno_acumulado_total"] == "melhor" and got["B", "retorno_acumulado_total"] == "pior"
    assert got["C", "retorno_acumulado_total"] is None
    assert got["A", "max_drawdown"] == "melhor" and got["B", "max_drawdown"] == "pior"
    assert got["B", "volatilidade_media_30d"] == "melhor" and got["C", "volatilidade_media_30d"] == "pior"
    assert {got[t, "dy_atual"] for t in "ABC"} == {"melhor"}


def test_comparison_keeps_tickers_without_yield(spark, company):
    summary = spark.createDataFrame(
        [(1, "AAA", -0.1, 0.5, 0.2, 10), (2, "BBB", -0.2, 0.1, 0.3, 5)],
        "empresa_id long, ticker string, max_drawdown double, retorno_acumulado_total double, "
        "volatilidade_media_30d double, total_pregoes long")
    yields = spark.createDataFrame(
        [(1, DAY, 0.07), (1, DAY + dt.timedelta(1), None)], "empresa_id long, data date, dy_12m double")
    got = {r.ticker: r for r in reports.comparison_table(summary, company, yields).collect()}
    assert got["AAA"].dy_atual == 0.07 and got["BBB"].dy_atual is None
    text = {r.ticker: r for r in reports.comparison_text(reports.comparison_table(summary, company, yields)).collect()}
    assert text["AAA"].dy_atual == "7.00%" and text["BBB"].dy_atual == "—" and text["AAA"].max_drawdown == "-10.0%"


def test_current_yield_of_a_ticker_without_rows_is_empty(spark, company):
    yields = spark.createDataFrame([(1, DAY, 0.07)], "empresa_id long, data date, dy_12m double")
    assert reports.current_yield(yields, company, "BBB").isEmpty()
    assert reports.current_yield(yields, company, "AAA").first().dy_12m == 0.07


def test_a_ticker_with_two_ids_is_an_error(spark, daily):
    double = spark.createDataFrame([(1, "AAA", "a"), (2, "AAA", "b")], COMPANY)
    empty = spark.createDataFrame([], "empresa_id long, data date, dy_12m double, fechamento_bruto double, dividendos_12m double")
    full = daily.selectExpr("*", "1d media_movel_200d", "1l pregoes_janela_200d", "1d media_movel_30d",
                            "1d volatilidade_30d_anual", "0d drawdown")
    summary = spark.createDataFrame([], "ticker string, max_drawdown double, retorno_acumulado_total double, total_pregoes long")
    with pytest.raises((PySparkException, Py4JJavaError), match="SCALAR_SUBQUERY_TOO_MANY_ROWS|more than one row"):
        reports.acceptance_blocks(double, full, empty, summary, "AAA")["janela_parcial"].collect()


def raw(spark, rows):
    return spark.createDataFrame(
        [(d, t, c, c, c, c, c, 1, d.year, d.month, d.day) for d, t, c in rows], RAW_QUOTES)


def test_session_gaps(spark):
    days = [DAY + dt.timedelta(i) for i in range(4)]
    rows = [(d, "A", 1.0) for d in days] + [(days[1], "B", 1.0), (days[1], "B", 2.0)]
    got = {(r.data, r.ticker) for r in exploratory.session_gaps(raw(spark, rows)).collect()}
    assert got == {(days[0], "B"), (days[2], "B"), (days[3], "B")}


@pytest.mark.parametrize("max_rows", [layout.MAX_ROWS_PER_KEY, 4])
def test_extreme_returns_break_ties_by_ticker_and_date(spark, max_rows):
    days = [DAY + dt.timedelta(i) for i in range(12)]
    rows = [(d, t, 10.0 if i % 2 else 5.0) for t in ("B", "A") for i, d in enumerate(days)]
    got = exploratory.extreme_returns(raw(spark, rows), top=3, max_rows=max_rows).collect()
    assert [(r.extremo, r.ticker, r.data, r.retorno_pct) for r in got] == [
        ("alta", "A", days[1], 100.0), ("alta", "A", days[3], 100.0), ("alta", "A", days[5], 100.0),
        ("queda", "A", days[2], -50.0), ("queda", "A", days[4], -50.0), ("queda", "A", days[6], -50.0)]


def test_coverage_names_missing_tickers(spark, company):
    got = reports.coverage_report(raw(spark, [(DAY, "AAA", 1.0), (DAY, "AAA", 1.0)]), company).first()
    assert tuple(got) == (2, 1, DAY, DAY, 2)


def test_reports_put_missing_keys_last(spark):
    names = spark.createDataFrame([(None,), ("B",), ("A",)], "ticker string")
    assert [r.ticker for r in reports.list_tickers(names).collect()] == ["A", "B", None]
    yields = spark.createDataFrame([(1, DAY, 0.5), (2, DAY, None), (3, DAY, 0.5)], "empresa_id long, data date, dy_12m double")
    company = spark.createDataFrame([(1, None), (2, "A"), (3, "C")], "empresa_id long, ticker string")
    assert [r.ticker for r in reports.yield_ranking(yields, company).collect()] == ["C", None, "A"]


def test_rejected_rows_are_counted_with_their_reason(spark, company):
    calendar = spark.createDataFrame([(DAY, 1)], "data date, tempo_id int")
    rows = raw(spark, [(DAY, "AAA", 1.0), (DAY, "ZZZ", 1.0), (DAY + dt.timedelta(1), "AAA", 1.0)])
    got = sorted((r.ticker, r.motivo) for r in facts.rejected_rows(rows, company, calendar).collect())
    assert got == [("AAA", "data"), ("ZZZ", "ticker")]
    both = raw(spark, [(DAY + dt.timedelta(1), "ZZZ", 1.0), (DAY, "AAA", 1.0)])
    assert [(r.ticker, r.motivo) for r in facts.rejected_rows(both, company, calendar).collect()] == [("ZZZ", "ticker e data")]
    assert facts.fact_quotes(rows, company, calendar).count() == 1


def test_multiset_difference_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")
    assert sorted(tuple(r) for r in sets.multiset_difference(a, b).collect()) == [(1, 1), (3, -1)]


def test_partition_difference_equals_the_whole_one(spark):
    rows = [(1, "a", None), (1, "a", None), (1, None, "a"), (2, "b", "c"), (2, "b", "c"), (3, "x", "y"), (None, "n", None), (None, None, "n")]
    other = [(1, "a", None), (1, None, "a"), (1, None, "a"), (2, "b", "c"), (2, "b", "c"), (4, "x", "y"), (None, None, "n"), (None, None, "n")]
    a, b = (spark.createDataFrame(r, "p int, x string, y string") for r in (rows, other))
    got, want = sets.partition_difference(a, b, ["p"]), sets.multiset_difference(a, b)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr) and want.count() == 6
    assert sets.partition_difference(a, a.orderBy("y"), ["p"]).isEmpty()


# Each check with a table that passes and one that fails.
CHECKS = {
    "not_null": (lambda d: quality.not_null(d, "k"), [(1, "a"), (2, None)], [(None, "a")]),
    "unique": (lambda d: quality.unique(d, "k"), [(1, "a"), (None, "a"), (None, "a")], [(1, "a"), (1, "b")]),
    "unique_combination": (
        lambda d: quality.unique_combination(d, ["k", "v"]), [(1, "a"), (1, "b")], [(1, "a"), (1, "a")]),
    "accepted_values": (lambda d: quality.accepted_values(d, "v", ["a"]), [(1, "a"), (2, None)], [(1, "b")]),
    "leftover_suffix": (
        lambda d: quality.leftover_suffix(d.withColumnRenamed("v", "ticker")), [(1, "A.SAO")], [(1, "A.SA")]),
    "relationships": (
        lambda d: quality.relationships(d, "k", d.sparkSession.range(3), "id"), [(1, "a"), (None, "b")], [(7, "a")]),
}


@pytest.mark.parametrize("name", CHECKS)
def test_check_passes_and_fails(spark, name):
    check, good, bad = CHECKS[name]
    assert check(spark.createDataFrame(good, "k long, v string")).isEmpty()
    assert check(spark.createDataFrame(bad, "k long, v string")).count() == 1


RULES = [
    ("fato_cotacoes_diarias", "volume_nao_negativo", {"volume": 0}, {"volume": -1}),
    ("fato_cotacoes_diarias", "maxima_maior_igual_minima", {"maxima": 2.0}, {"maxima": 0.5}),
    ("fato_cotacoes_diarias", "fechamento_dentro_do_range", {"fechamento": 2.0}, {"fechamento": 2.5}),
    ("mart_indicadores_diarios", "drawdown_nao_positivo", {"drawdown": 0.0}, {"drawdown": 0.1}),
    ("mart_indicadores_diarios", "volatilidade_nao_negativa", {"volatilidade_90d": 0.0}, {"volatilidade_90d": -0.1}),
    ("mart_dividend_yield", "yield_nao_negativo", {"dy_12m": 0.0}, {"dy_12m": -0.1}),
]


@pytest.mark.parametrize("table,rule,good,bad", RULES)
def test_row_rules(spark, table, rule, good, bad):
    base = {"volume": 1, "maxima": 2.0, "minima": 1.0, "fechamento": 1.5, "drawdown": -0.1, "dy_12m": 0.1,
            "volatilidade_30d": 0.1, "volatilidade_90d": 0.1, "volatilidade_252d": 0.1}
    schema = ", ".join(f"{c} {'long' if c == 'volume' else 'double'}" for c in base)
    nothing = {c: None for c in base}
    ok = spark.createDataFrame([tuple({**base, **good}.values()), tuple(nothing.values())], schema)
    assert quality.violates(ok, table, rule).isEmpty()
    assert quality.violates(spark.createDataFrame([tuple({**base, **bad}.values())], schema), table, rule).count() == 1


def test_first_session_check(daily):
    full = daily.withColumn("tempo_id", scalar.date_key(F.col("data")))
    assert quality.first_session_return(full).isEmpty()
    assert quality.first_session_return(full.where(F.col("data") > F.lit(DAY))).count() == 3


def test_scalar_functions(spark):
    row = spark.range(1).select(
        scalar.ln(F.lit(0.0)), scalar.ratio(F.lit(1.0), F.lit(0.0)), scalar.percent_text(F.lit(0.0712)),
        scalar.percent_text(F.lit(None).cast("double")), scalar.without_suffix(F.lit("X.SA")),
        scalar.without_suffix(F.lit("XBSA")), scalar.with_suffix(F.lit("X")),
        scalar.percent(F.lit(0.12345), 2), scalar.month_start(F.lit(2024), F.lit(2))).first()
    assert tuple(row) == (None, None, "7.1%", "—", "X", "XBSA", "X.SA", 12.35, dt.date(2024, 2, 1))
    assert scalar.parse_day("2024-02-29") == dt.date(2024, 2, 29)
    for bad in ("2024-02-30", "29/02/2024", None):
        with pytest.raises(ValueError):
            scalar.parse_day(bad)
