import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tapework.operators import indicators, layout
from tapework.operators.dimensions import dim_calendar
from tapework.functions.series import SeriesWindow
from tapework.sources.generated import calendar_days

BASE = "empresa_id long, tempo_id int, data date, fechamento_ajustado double, volume long"
LENGTHS = (1, 2, 8, 31, 91, 201, 253, 300)


def indicators_of(df, max_rows=layout.MAX_ROWS_PER_KEY):
    return layout.over_series(df, indicators.indicator_columns, key="empresa_id", date="data", halo=253,
                              carry=("fechamento_ajustado",), max_rows=max_rows)


def brute_force(rows):
    """The definitions, row by row, for one company."""
    out, prices, logs = [], [], []
    for _, tempo_id, _, price, _ in rows:
        before = prices[-1] if prices else None
        prices.append(price)
        logs.append(math.log(price / before) if before else None)
        row = {
            "tempo_id": tempo_id,
            "retorno_simples": price / before - 1 if before else None,
            "retorno_log": logs[-1],
            "retorno_acumulado": price / prices[0] - 1,
            "pico_historico": max(prices),
            "drawdown": price / max(prices) - 1,
        }
        for n in (7, 30, 90, 200):
            window = prices[-n:]
            row[f"media_movel_{n}d"] = sum(window) / len(window)
            row[f"pregoes_janela_{n}d"] = len(window)
        for n in (30, 90, 252):
            window = [x for x in logs[-n:] if x is not None]
            vol = statistics.stdev(window) if len(window) > 1 else None
            row[f"volatilidade_{n}d"] = vol
            row[f"volatilidade_{n}d_anual"] = vol * math.sqrt(252) if vol is not None else None
        out.append(row)
    return out


def assert_same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for name, value in w.items():
            if isinstance(value, float):
                assert g[name] == pytest.approx(value, rel=1e-9, abs=1e-9), (name, w["tempo_id"])
            else:
                assert g[name] == value, (name, w["tempo_id"])


@pytest.mark.parametrize("max_rows", [layout.MAX_ROWS_PER_KEY, 150, 40])
def test_daily_indicators_match_their_definition(spark, price_series, max_rows):
    series = {i: price_series(i, n, seed=i) for i, n in enumerate(LENGTHS)}
    rows = [r for s in series.values() for r in s]
    random.Random(1).shuffle(rows)
    result = indicators_of(spark.createDataFrame(rows, BASE), max_rows)
    assert len(result.columns) == 24
    got = [r.asDict() for r in result.orderBy("empresa_id", "data").collect()]
    assert len(got) == len(rows)
    for key, own in series.items():
        assert_same([g for g in got if g["empresa_id"] == key], brute_force(own))


def test_first_session_and_partial_windows(spark, price_series):
    row = indicators_of(spark.createDataFrame(price_series(1, 3), BASE)).orderBy("data").first()
    assert row.retorno_simples is None and row.retorno_log is None
    assert row.retorno_acumulado == 0 and row.drawdown == 0
    assert row.pregoes_janela_200d == 1 and row.volatilidade_30d is None


def test_flat_prices_have_exactly_no_volatility(spark):
    day = dt.date(2020, 1, 1)
    rows = [(1, i, day + dt.timedelta(i), p, 1) for i, p in enumerate([10.0, 11.3, 9.7] + [12.1] * 60)]
    last = indicators_of(spark.createDataFrame(rows, BASE)).orderBy("data").collect()[-1]
    assert last.volatilidade_30d == 0.0 and last.volatilidade_90d > 0


def test_values_that_are_not_finite_stay_inside_their_windows(spark):
    day = dt.date(2020, 1, 1)
    prices = [10.0, 11.0, float("nan"), 12.0, 13.0] + [14.0] * 40
    rows = [(1, i, day + dt.timedelta(i), p, 1) for i, p in enumerate(prices)]
    got = indicators_of(spark.createDataFrame(rows, BASE)).orderBy("data").collect()
    assert math.isnan(got[8].media_movel_7d) and got[9].media_movel_7d == pytest.approx(95 / 7)
    assert math.isnan(got[20].volatilidade_30d) and not math.isnan(got[40].volatilidade_30d)


def test_large_early_prices_cost_later_averages_no_digits(spark):
    day = dt.date(2010, 1, 1)
    prices = [9e7 + i / 7 for i in range(300)] + [1.1 + i / 1000 for i in range(300)]
    rows = [(1, i, day + dt.timedelta(i), p, 1) for i, p in enumerate(prices)]
    last = indicators_of(spark.createDataFrame(rows, BASE)).orderBy("data").collect()[-1]
    assert last.media_movel_7d == pytest.approx(sum(prices[-7:]) / 7, rel=1e-13)
    assert last.media_movel_200d == pytest.approx(sum(prices[-200:]) / 200, rel=1e-13)


def test_zero_price_gives_null_log_and_return(spark):
    day = dt.date(2020, 1, 1)
    rows = [(1, i, day + dt.timedelta(i), p, 1) for i, p in enumerate([10.0, 0.0, 5.0])]
    got = indicators_of(spark.createDataFrame(rows, BASE)).orderBy("data").collect()
    assert got[1].retorno_simples == -1 and got[1].retorno_log is None
    assert got[2].retorno_simples is None and got[2].retorno_log is None


@pytest.mark.parametrize("days", [1, 5, 4000])
def test_hot_key_is_split_and_whole(spark, days):
    """A third of all rows under one key, also when they all fall on one day."""
    start = F.lit(dt.date(2005, 1, 1))
    keyed = spark.range(36_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 600 + 1).alias("empresa_id"), "id")
    hot_day = F.date_add(start, ((F.col("id") / 3) % days).cast("int"))
    day = F.when(F.col("empresa_id") == 0, hot_day).otherwise(F.date_add(start, (F.col("id") / 600).cast("int")))
    df = keyed.select(
        "empresa_id", F.col("id").cast("int").alias("tempo_id"), day.alias("data"),
        (F.pmod(F.hash("id"), F.lit(90)) + 10).cast("double").alias("fechamento_ajustado"),
        F.lit(1).cast("long").alias("volume"))
    _, hot, _ = layout.split_hot(df, "empresa_id", 1000)
    blocks = layout.split_series(hot, key="empresa_id", date="data", halo=253,
                                 carry=("fechamento_ajustado",), block_rows=1000)
    sizes = blocks.groupBy("_block").agg(F.count(F.lit(1)).alias("n"), F.count_if("_own").alias("own")).collect()
    assert sum(s.own for s in sizes) == 12_000
    assert len(sizes) >= 8 and max(s.n for s in sizes) < 4_000
    result = indicators_of(df, 1000)
    assert result.count() == 36_000
    # whatever order rows of one day take, every series has one first row and counts up to 200
    of_hot = result.where("empresa_id = 0")
    assert of_hot.where(F.col("retorno_simples").isNull()).count() == 1
    fills = dict(of_hot.groupBy("pregoes_janela_200d").count().collect())
    assert fills == {**{i: 1 for i in range(1, 200)}, 200: 12_000 - 199}
    assert of_hot.agg(F.max("pico_historico")).first()[0] == df.where("empresa_id = 0").agg(
        F.max("fechamento_ajustado")).first()[0]


def test_split_equals_whole_on_a_long_series(spark, price_series):
    df = spark.createDataFrame(price_series(7, 3000, step=1) + price_series(8, 50), BASE)
    whole, split = (
        [r.asDict() for r in indicators_of(df, m).orderBy("empresa_id", "data").collect()]
        for m in (100_000, 400))
    assert_same(split, whole)


def test_log_returns_add_up(spark, price_series):
    rows = price_series(1, 120)
    total = indicators_of(spark.createDataFrame(rows, BASE)).agg(F.sum("retorno_log")).first()[0]
    assert total == pytest.approx(math.log(rows[-1][3] / rows[0][3]))


def test_summary_skips_null_volume_and_return(spark, price_series):
    rows = price_series(1, 40)
    company = spark.createDataFrame([(1, "AAA")], "empresa_id long, ticker string")
    got = indicators.indicator_summary(indicators_of(spark.createDataFrame(rows, BASE)), company).first()
    known = [r[4] for r in rows if r[4] is not None]
    assert got.volume_medio == pytest.approx(sum(known) / len(known))
    assert got.total_pregoes == 40 and got.primeiro_pregao == rows[0][2] and got.ultimo_pregao == rows[-1][2]
    assert got.retorno_acumulado_total == rows[-1][3] / rows[0][3] - 1


# --- dividend yield --------------------------------------------------------------------------------

QUOTE = "empresa_id long, tempo_id int, fechamento double"
EVENT = "empresa_id long, tempo_id int, valor_dividendo double"


def key(day):
    return int(day.strftime("%Y%m%d"))


@pytest.fixture(scope="module")
def calendar(spark):
    return dim_calendar(calendar_days(spark, dt.date(2010, 1, 1), dt.date(2024, 12, 31))).cache()


def yields(spark, calendar, quotes, events, **options):
    return indicators.dividend_yield(
        spark.createDataFrame(quotes, QUOTE), spark.createDataFrame(events, EVENT), calendar, **options)


@pytest.mark.parametrize("offset,counted", [(-366, 0), (-365, 0), (-364, 1), (-1, 1), (0, 1), (1, 0)])
def test_yield_window_is_365_days_half_open(spark, calendar, offset, counted):
    day = dt.date(2020, 6, 15)
    got = yields(spark, calendar, [(1, key(day), 50.0)], [(1, key(day + dt.timedelta(offset)), 2.0)]).first()
    assert got.dividendos_12m == 2.0 * counted and got.dy_12m == 2.0 * counted / 50.0


def test_yield_is_zero_without_dividends_and_counts_weekend_events(spark, calendar):
    monday, saturday = dt.date(2020, 6, 15), dt.date(2020, 6, 13)
    got = yields(spark, calendar, [(1, key(monday), 10.0), (2, key(monday), 10.0)], [(2, key(saturday), 1.0)])
    assert {r.empresa_id: r.dy_12m for r in got.collect()} == {1: 0.0, 2: 0.1}


def test_yield_returns_to_exactly_zero_after_fractional_amounts(spark, calendar):
    start = dt.date(2015, 1, 1)
    events = [(1, key(start + dt.timedelta(i)), 0.1 * (i % 7 + 1)) for i in range(300)]
    quotes = [(1, key(start + dt.timedelta(i)), 7.0) for i in range(0, 900, 5)]
    got = yields(spark, calendar, quotes, events).collect()
    assert all(r.dividendos_12m >= 0 for r in got)
    late = [r for r in got if r.data > start + dt.timedelta(299 + 364)]
    assert late and all(r.dividendos_12m == 0.0 for r in late)


@pytest.mark.parametrize("max_rows", [layout.MAX_ROWS_PER_KEY, 100])
def test_yield_equals_range_join(spark, calendar, max_rows):
    rng = random.Random(5)
    start = dt.date(2011, 1, 1)
    quotes, events = [], []
    for company in range(6):
        for _ in range(400 if company == 0 else 60):
            # repeated company and day on purpose
            quotes.append((company, key(start + dt.timedelta(rng.randrange(900 if company else 300))),
                           float(rng.randrange(1, 90))))
        for _ in range(30):
            events.append((company, key(start + dt.timedelta(rng.randrange(1200))), rng.randrange(1, 500) / 4))
    quotes += quotes[:50]
    got = yields(spark, calendar, quotes, events, max_rows=max_rows)
    want = indicators.dividend_yield_by_join(
        spark.createDataFrame(quotes, QUOTE), spark.createDataFrame(events, EVENT), calendar)
    want = want.select(got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


# --- plans -----------------------------------------------------------------------------------------

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_indicators_need_one_exchange_and_one_sort(spark, price_series):
    df = spark.createDataFrame(price_series(1, 5), BASE)
    order = [F.col("data").asc_nulls_last()]
    text = plan(indicators.indicator_columns(df, SeriesWindow(["empresa_id"], order)))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1


def test_no_average_frame_grows_with_the_window_length(spark, price_series):
    text = plan(indicators.indicator_columns(
        spark.createDataFrame(price_series(1, 5), BASE),
        SeriesWindow(["empresa_id"], [F.col("data").asc_nulls_last()])))
    assert "RowFrame, -6, currentrow" not in text and "RowFrame, -199, currentrow" not in text


def logs_of(prices):
    return [math.log(b / a) for a, b in zip(prices, prices[1:])]


@pytest.mark.parametrize("max_rows", [layout.MAX_ROWS_PER_KEY, 300])
def test_volatility_forgets_what_left_its_window(spark, max_rows):
    calm = [100.0 * 1.01**i for i in range(900)]
    bad_tick = [100.0, 1e9, 100.0] + [100.0 * (1 + 1e-6 * math.sin(i)) for i in range(900)]
    rows = [(company, i, dt.date(2010, 1, 4) + dt.timedelta(i), price, 1)
            for company, prices in ((1, calm), (2, bad_tick)) for i, price in enumerate(prices)]
    got = {(r.empresa_id, r.tempo_id): r for r in indicators_of(spark.createDataFrame(rows, BASE), max_rows).collect()}
    for n in (30, 90, 252):
        assert all(got[1, i][f"volatilidade_{n}d"] < 1e-15 for i in range(2, 900))
        logs = logs_of(bad_tick)
        for i in (400, 600, 902):
            assert got[2, i][f"volatilidade_{n}d"] == pytest.approx(statistics.stdev(logs[i - n:i]), rel=1e-9)


def test_both_layouts_give_the_same_bits_after_a_bad_tick(spark):
    prices = [100.0, 1e9, 100.0] + [100.0 + 0.01 * (i * 7919 % 97) for i in range(900)]
    rows = spark.createDataFrame([(1, i, dt.date(2010, 1, 4) + dt.timedelta(i), p, 1) for i, p in enumerate(prices)], BASE)
    whole, split = indicators_of(rows), indicators_of(rows, 300)
    columns = [c for c in whole.columns if c.startswith("volatilidade")]
    assert whole.select("tempo_id", *columns).exceptAll(split.select("tempo_id", *columns)).isEmpty()


@pytest.mark.parametrize("amount", [float("nan"), float("inf"), 1e17])
@pytest.mark.parametrize("max_rows", [layout.MAX_ROWS_PER_KEY, 50])
def test_yield_forgets_an_odd_dividend_after_a_year(spark, calendar, amount, max_rows):
    start = dt.date(2011, 1, 1)
    events = [(1, key(start + dt.timedelta(40)), amount)] + [(1, key(start + dt.timedelta(i)), 0.5 + i / 100) for i in range(0, 1500, 91)]
    quotes = [(1, key(start + dt.timedelta(i)), 4.0) for i in range(0, 1800, 7)]
    got = {r.tempo_id: r.dividendos_12m for r in yields(spark, calendar, quotes, events, max_rows=max_rows).collect()}
    for _, tempo_id, _ in quotes:
        day = dt.datetime.strptime(str(tempo_id), "%Y%m%d").date()
        window = sorted((e, v) for _, e, v in events if key(day - dt.timedelta(364)) <= e <= tempo_id)
        want = 0.0
        for _, v in window:
            want += v
        assert got[tempo_id] == pytest.approx(want, rel=1e-12, nan_ok=True)


def test_yield_shuffles_quotes_once_and_has_no_nested_loop_join(spark, calendar):
    text = plan(yields(spark, calendar, [(1, 20200615, 1.0)], [(1, 20200614, 1.0)]))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    # dividends per day, their trailing totals, then quotes and totals together
    assert text.count("Exchange hashpartitioning") == 3


@pytest.mark.parametrize("block_days,max_rows", [(182, 200_000), (30, 200_000), (400, 7)])
def test_interval_join_splits_a_hot_company(spark, calendar, block_days, max_rows):
    """A third of all sessions in one company on few days, against sums over all pairs."""
    rng = random.Random(6)
    days = [r.tempo_id for r in calendar.orderBy("tempo_id").collect()]
    quotes = [(0 if i % 3 == 0 else i % 20, rng.choice(days[-5:] if i % 3 == 0 else days), float(rng.randint(1, 40))) for i in range(900)]
    events = [(rng.choice([0, 0, 1, 2, 3]), rng.choice(days), float(rng.randint(1, 9))) for _ in range(300)]
    got = indicators.dividend_yield_by_join(
        spark.createDataFrame(quotes, "empresa_id long, tempo_id int, fechamento double"),
        spark.createDataFrame(events, "empresa_id long, tempo_id int, valor_dividendo double"), calendar, block_days, max_rows).collect()
    day = {r.tempo_id: r.data for r in calendar.collect()}
    want = {}
    for company, at, price in quotes:
        paid = sum(v for c, e, v in events if c == company and 0 <= (day[at] - day[e]).days < 365)
        want[company, at, price] = want.get((company, at, price), 0) + paid
    assert {(r.empresa_id, r.tempo_id, r.fechamento_bruto): r.dividendos_12m for r in got} == want


def test_averages_and_volatilities_keep_their_digits(spark):
    """After a bad tick and on constant growth, against sums taken in full."""
    day = dt.date(2010, 1, 4)
    series = {1: [100.0 * 1.001**i for i in range(600)], 2: [100.0, 1e12, 100.0] + [100 + 1e-3 * (i * 7919 % 97) for i in range(600)]}
    rows = [(k, i, day + dt.timedelta(i), p, 1) for k, prices in series.items() for i, p in enumerate(prices)]
    got = {(r.empresa_id, r.tempo_id): r for r in indicators_of(spark.createDataFrame(rows, BASE)).collect()}
    for k, prices in series.items():
        logs = logs_of(prices)
        for i in (300, 450, 599):
            for n in (7, 30, 90, 200):
                assert got[k, i][f"media_movel_{n}d"] == pytest.approx(math.fsum(prices[i - n + 1:i + 1]) / n, rel=1e-14)
            for n in (30, 90, 252):
                assert got[k, i][f"volatilidade_{n}d"] == pytest.approx(statistics.stdev(logs[i - n:i]), rel=1e-12, abs=1e-15)


def test_both_layouts_give_the_same_bits(spark, price_series):
    df = spark.createDataFrame(price_series(7, 1500, step=1) + price_series(8, 50), BASE)
    whole, split = indicators_of(df), indicators_of(df, 300)
    assert whole.exceptAll(split).isEmpty() and split.exceptAll(whole).isEmpty()
