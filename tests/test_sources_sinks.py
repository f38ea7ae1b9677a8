import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapework import cli, session
from tapework.operators import dimensions, sets, staging
from tapework.plans import loads
from tapework.schemas import (
    DIVIDENDS, PRICE_COLUMNS, QUOTES, RAW_DIVIDENDS, VENDOR_METRICS, assert_schema, empty, schema_problems,
)
from tapework.sinks import partitioned
from tapework.sinks.layers import create_layer, materialize
from tapework.sources import raw, vendor
from tapework.sources.generated import calendar_days, literal_mapping

DAY = dt.date(2024, 2, 28)


def bars(spark, *rows):
    return spark.createDataFrame(rows, QUOTES)


def bar(day, ticker, price=10.0, volume=100):
    return (day, ticker, price, price + 1, price - 1, price, price, volume)


def same(a, b):
    return sets.multiset_difference(a, b.select(a.columns)).isEmpty()


# --- vendor ----------------------------------------------------------------------------------------

def test_wide_bars_become_long(spark):
    columns = ["Date"] + [vendor.wide_column(t, m) for t in ("AAA3", "B.SA4") for m in VENDOR_METRICS]
    rows = [
        (dt.datetime(2024, 2, 28), 1.0, 2.0, 0.5, 1.5, 1.4, 100.0, None, None, None, None, None, 5.0),
        (dt.datetime(2024, 2, 29), None, None, None, None, 1.6, None, 3.0, 4.0, 2.0, 3.5, 3.5, 7.0),
    ]
    got = vendor.normalize_vendor_bars(
        spark.createDataFrame(rows, ", ".join(f"`{c}` {'timestamp' if c == 'Date' else 'double'}" for c in columns)),
        ["AAA3", "B.SA4"])
    assert not schema_problems(got, QUOTES)
    want = bars(
        spark, (DAY, "AAA3", 1.0, 2.0, 0.5, 1.5, 1.4, 100),
        (dt.date(2024, 2, 29), "AAA3", None, None, None, None, 1.6, None),
        (dt.date(2024, 2, 29), "B.SA4", 3.0, 4.0, 2.0, 3.5, 3.5, 7))
    assert same(got, want)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_flat_bars_need_exactly_one_ticker(spark):
    flat = spark.createDataFrame([(DAY, 1.0, 2.0, 0.5, 1.5, 1.4, 100)], ["Date", *VENDOR_METRICS])
    assert vendor.normalize_vendor_bars(flat, ["AAA3"]).first().ticker == "AAA3"
    with pytest.raises(ValueError):
        vendor.normalize_vendor_bars(flat, ["AAA3", "BBB4"])
    with pytest.raises(ValueError):
        vendor.normalize_vendor_bars(flat, [])


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Sao_Paulo"])
def test_ex_date_is_the_exchange_date(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # midnight in São Paulo is 03:00 UTC
        frame = spark.sql(
            "select timestamp_seconds(unix_timestamp(timestamp '2024-02-28 03:00:00+00:00')) as Date, "
            "0.5d as Dividends, 'AAA3' as ticker")
        got = vendor.normalize_vendor_dividends([frame, frame.withColumn("ticker", F.lit("BBB4"))])
        assert not schema_problems(got, DIVIDENDS)
        assert [(r.data_ex, r.ticker) for r in got.orderBy("ticker").collect()] == [(DAY, "AAA3"), (DAY, "BBB4")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_companies_seed_keeps_quoted_commas_and_accents(spark, tmp_path):
    seed = tmp_path / "companies.csv"
    seed.write_text('ticker,nome,setor,subsetor,segmento\nAAA3,Água,"Petróleo, Gás","x ""y""",z\n', encoding="utf-8")
    assert tuple(raw.read_companies(spark, str(seed)).first()) == ("AAA3", "Água", "Petróleo, Gás", 'x "y"', "z")


# --- staging ---------------------------------------------------------------------------------------

def test_staging_drops_partial_bars_but_not_missing_volume(spark):
    good = bar(DAY, "AAA3", volume=None)
    rows = [good]
    for position in (2, 3, 4):
        for value in (0.0, None, -1.0):
            rows.append((*good[:position], value, *good[position + 1:]))
    rows.append((*good[:6], None, good[7]))
    # raw and adjusted close are not tested for being above zero
    kept = (*good[:5], 0.0, -1.0, 0)
    assert same(staging.stg_quotes(bars(spark, *rows, kept)), bars(spark, good, kept))


def test_staging_drops_dividends_not_above_zero(spark):
    rows = [(DAY, "AAA3", v) for v in (None, 0.0, -1.0, 0.25)]
    assert [r.valor_dividendo for r in staging.stg_dividends(spark.createDataFrame(rows, DIVIDENDS)).collect()] == [0.25]


def test_only_rows_without_any_price_are_empty(spark):
    nothing = (DAY, "AAA3", None, float("nan"), None, None, None, 5)
    one = (DAY, "AAA3", None, None, None, None, 2.0, None)
    assert staging.drop_empty_bars(bars(spark, nothing, one)).count() == 1


# --- partitions ------------------------------------------------------------------------------------

def test_rewriting_a_day_replaces_it_and_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "q")
    days = [DAY, dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert partitioned.write_quotes(bars(spark, *[bar(d, t) for d in days for t in ("A", "B")]), path) == 3
    assert (tmp_path / "q" / "ano=2024" / "mes=02" / "dia=28").is_dir()
    assert partitioned.write_quotes(bars(spark, bar(DAY, "A", 99.0)), path) == 1
    got = raw.read_raw_quotes(spark, path)
    assert got.count() == 5
    row = got.where(F.col("data") == F.lit(DAY)).first()
    assert (row.fechamento, row.ano, row.mes, row.dia) == (99.0, 2024, 2, 28)


@pytest.mark.parametrize("granularity", ["day", "month", "year"])
def test_granularities_read_back_the_same(spark, tmp_path, granularity):
    rows = bars(spark, *[bar(DAY + dt.timedelta(40 * i), "A", 5.0 + i) for i in range(12)])
    partitioned.write_quotes(rows, str(tmp_path / "q"), granularity)
    got = raw.read_raw_quotes(spark, str(tmp_path / "q"), granularity)
    assert same(rows, got) and got.where(F.col("dia") != F.dayofmonth("data")).isEmpty()


@pytest.mark.parametrize("granularity", ["day", "month", "year"])
def test_a_partial_load_keeps_every_other_row(spark, tmp_path, granularity):
    path, first = str(tmp_path / "q"), dt.date(2024, 1, 20)
    rows = bars(spark, *[bar(first + dt.timedelta(i), t, 5.0 + i) for i in range(40) for t in ("A", "B")])
    loads.load_quotes(rows, path, "inicial", dt.date(2024, 3, 1), granularity=granularity)
    changed = rows.withColumn("volume", F.lit(7).cast("long"))
    for mode, today, start, end, days in (("diario", dt.date(2024, 2, 10), None, None, 1), ("range", DAY, dt.date(2024, 1, 30), dt.date(2024, 2, 2), 4)):
        loads.load_quotes(changed, path, mode, today, start, end, granularity)
        got = raw.read_raw_quotes(spark, path, granularity)
        low, high = (start, end) if start else (today, today)
        inside = F.col("data").between(low, high)
        assert got.count() == 80 and got.where(inside & (F.col("volume") == 7)).count() == 2 * days
    assert got.where("volume = 7").count() == 10 and same(rows.drop("volume"), got.select(rows.drop("volume").columns))


def test_all_history_is_a_choice(spark, tmp_path):
    rows = bars(spark, bar(dt.date(1990, 1, 2), "A"), bar(DAY, "A"))
    assert loads.load_quotes(rows, str(tmp_path / "a"), "inicial", DAY) == 1
    assert loads.load_quotes(rows, str(tmp_path / "b"), "inicial", DAY, years=None) == 2


def test_a_large_partition_is_rebalanced(spark, tmp_path):
    rows = spark.range(5000).select(
        F.lit(DAY).alias("data"), F.format_string("T%d", "id").alias("ticker"),
        *[F.lit(1.0).alias(c) for c in PRICE_COLUMNS], F.col("id").alias("volume"))
    keys = ["ano", "mes", "dia"]
    assert partitioned._write(rows, str(tmp_path / "q"), "data", keys) == 1
    assert same(rows, raw.read_raw_quotes(spark, str(tmp_path / "q")))


def test_empty_input_writes_nothing_and_order_is_checked(spark, tmp_path):
    assert partitioned.write_quotes(empty(spark, QUOTES), str(tmp_path / "q")) == 0
    assert raw.read_raw_quotes(spark, str(tmp_path / "q")).isEmpty()
    assert raw.read_raw_dividends(spark, str(tmp_path / "d")).schema == RAW_DIVIDENDS
    with pytest.raises(ValueError):
        partitioned.write_quotes(empty(spark, QUOTES).select(*reversed(QUOTES.names)), str(tmp_path / "q"))


def test_dividends_of_one_year_only(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = [(dt.date(y, 5, 1), "A", float(y)) for y in (2022, 2023, 2024)]
    partitioned.write_dividends(spark.createDataFrame(rows, DIVIDENDS), path)
    changed = spark.createDataFrame([(d, t, v + 0.5) for d, t, v in rows], DIVIDENDS)
    assert partitioned.write_dividends(changed, path, {2024}) == 1
    got = {r.ano: r.valor_dividendo for r in raw.read_raw_dividends(spark, path).collect()}
    assert got == {2022: 2022.0, 2023: 2023.0, 2024: 2024.5}


def test_period_reads_prune_partitions(spark, tmp_path):
    partitioned.write_quotes(bars(spark, *[bar(dt.date(y, 1, 2), "A") for y in range(2015, 2024)]), str(tmp_path))
    got = raw.with_partition_bounds(raw.read_raw_quotes(spark, str(tmp_path)), dt.date(2020, 1, 1), dt.date(2021, 1, 2))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 2
    pruned = text.split("PartitionFilters: [")[1].split("]")[0]
    assert all(c in pruned for c in ("ano", "mes", "dia"))


# --- layers, dimensions ----------------------------------------------------------------------------

def test_layers_can_be_created_and_refreshed_again(spark, tmp_path):
    root = str(tmp_path)
    for price in (1.0, 2.0):
        create_layer(spark, "layer_test", root)
        table = materialize(bars(spark, bar(DAY, "A", price)), "layer_test", "t", "table", root)
        assert table.first().fechamento == price and table.count() == 1
    assert materialize(table, "layer_test", "v", "view").count() == 1
    with pytest.raises(ValueError):
        materialize(table, "layer_test", "v", "other")


def test_surrogate_keys_follow_ticker_order(spark):
    tickers = spark.range(500).select(F.format_string("T%05d", (F.col("id") * 7919) % 500).alias("ticker"))
    companies = tickers.repartition(7).select("ticker", *[
        F.lit("x").alias(c) for c in ("nome", "setor", "subsetor", "segmento")])
    got = dimensions.dim_company(companies).orderBy("ticker").collect()
    assert [r.empresa_id for r in got] == list(range(1, 501))


def test_calendar_attributes(spark):
    cal = dimensions.dim_calendar(calendar_days(spark, dt.date(2020, 1, 1), dt.date(2030, 12, 31)))
    assert cal.count() == 4018
    rows = {r.data: r for r in cal.where("tempo_id in (20240229, 20240301, 20240303)").collect()}
    leap = rows[dt.date(2024, 2, 29)]
    assert (leap.nome_mes, leap.nome_dia_semana, leap.dia_semana, leap.trimestre) == ("Fevereiro", "Quinta-feira", 4, 1)
    assert leap.eh_fim_mes and not leap.eh_fim_semana
    assert rows[dt.date(2024, 3, 1)].eh_inicio_mes
    assert rows[dt.date(2024, 3, 3)].dia_semana == 0 and rows[dt.date(2024, 3, 3)].eh_fim_semana
    with pytest.raises(ValueError):
        calendar_days(spark, dt.date(2020, 1, 2), dt.date(2020, 1, 1))


def test_literal_mapping(spark):
    assert dict(literal_mapping(spark, {"A": "x", "B": "y"}).collect()) == {"A": "x", "B": "y"}


class _Session:
    """The few settings that shared_folder reads."""

    def __init__(self, master, folder=None, checkpoint=None):
        self.master, self.folder, self.checkpoint = master, folder, checkpoint
        self.conf = self.sparkContext = self

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.folder or default

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, folder):
        self.checkpoint = folder


def test_shared_folder_comes_from_the_session():
    assert session.shared_folder(_Session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    assert session.shared_folder(_Session("yarn", checkpoint="hdfs://x/z")) == "hdfs://x/z"
    local = _Session("local[2]")
    assert session.shared_folder(local) == local.checkpoint == session.shared_folder(local)
    with pytest.raises(RuntimeError):
        session.shared_folder(_Session("yarn"))


# --- loads -----------------------------------------------------------------------------------------

def test_load_intervals():
    today = dt.date(2024, 3, 1)
    assert loads.load_interval("inicial", today) == (today - dt.timedelta(1825), today)
    assert loads.load_interval("diario", today) == (today, today)
    assert loads.load_interval("range", today, DAY, today) == (DAY, today)
    for bad in [("range", today), ("range", today, today, DAY), ("other", today)]:
        with pytest.raises(ValueError):
            loads.load_interval(*bad)


def test_daily_load_without_session_succeeds(spark, tmp_path):
    rows = bars(spark, bar(DAY, "A"))
    assert loads.load_quotes(rows, str(tmp_path), "diario", dt.date(2024, 3, 1)) == 0
    assert loads.load_quotes(rows, str(tmp_path), "diario", DAY) == 1
    with pytest.raises(ValueError):
        loads.load_quotes(bars(spark, bar(DAY, "A.SA")), str(tmp_path), "diario", DAY)


def test_schema_contract(spark):
    assert_schema(empty(spark, QUOTES), QUOTES)
    for broken in (empty(spark, QUOTES).drop("volume"), empty(spark, QUOTES).withColumn("volume", F.lit(1.0))):
        with pytest.raises(ValueError):
            assert_schema(broken, QUOTES)


@pytest.fixture
def run(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("ticker,nome,setor,subsetor,segmento\nAAA3,a,s,t,u\nBBB4,b,s,t,u\n")
    return loads.DailyRun(
        str(tmp_path / "w"), str(tmp_path / "seed.csv"), ["AAA3", "BBB4"], dt.date(2024, 1, 1), dt.date(2024, 12, 31))


def test_daily_run_builds_all_layers_and_passes(spark, run):
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(40)]
    quotes = bars(spark, *[bar(d, t, 10.0 + d.day) for d in days for t in ("AAA3", "BBB4")])
    dividends = spark.createDataFrame([(days[5], "AAA3", 0.5)], DIVIDENDS)
    for today in days[30:33]:
        report = loads.run_daily(spark, run, quotes, dividends, today)
    assert report.count() == 49 and report.where("not aprovado").isEmpty()
    assert spark.table("marts.mart_indicadores_diarios").count() == 6
    assert spark.table("marts.mart_dividend_yield").where("dy_12m > 0").count() == 3
    other = spark.newSession()
    assert other.table("staging.stg_cotacoes").count() == 6 and other.table("staging.stg_dividendos").count() == 1
    assert other.table("marts.fato_dividendos").count() == 1


def test_daily_run_from_the_command_line(spark, run, tmp_path):
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(10)]
    bars(spark, *[bar(d, t, 10.0 + d.day) for d in days for t in ("AAA3", "BBB4")]).write.parquet(str(tmp_path / "q"))
    spark.createDataFrame([(days[5], "AAA3", 0.5)], DIVIDENDS).write.parquet(str(tmp_path / "d"))
    command = ["dia", "--raiz", run.root, "--cotacoes", str(tmp_path / "q"), "--dividendos", str(tmp_path / "d"), "--empresas", run.companies_csv,
               "--tickers", "AAA3,BBB4", "--calendario", "2024-01-01", "2024-12-31", "--hoje"]
    assert cli.main([*command, "2024-01-06"]) == 0
    assert raw.read_raw_quotes(spark, run.quotes_path).count() == 2
    bars(spark, (DAY, "AAA3", 10.0, 5.0, 9.0, 10.0, 10.0, 1)).write.parquet(str(tmp_path / "bad"))
    assert cli.main([*command[:4], str(tmp_path / "bad"), *command[5:], str(DAY)]) == 1


def test_vendor_frame_to_raw_layer(spark, tmp_path):
    columns = ["Date"] + [vendor.wide_column(t, m) for t in ("AAA3", "BBB4") for m in VENDOR_METRICS]
    wide = spark.createDataFrame([(dt.datetime(2024, 2, 28), 1.0, 2.0, 0.5, 1.5, 1.4, 100.0, *[None] * 6)],
                                 ", ".join(f"`{c}` {'timestamp' if c == 'Date' else 'double'}" for c in columns))
    written, coverage = loads.ingest_vendor_bars(wide, ["AAA3", "BBB4"], str(tmp_path / "q"), "diario", DAY)
    assert written == 1 and raw.read_raw_quotes(spark, str(tmp_path / "q")).count() == 1
    assert tuple(coverage.first()) == (1, 1, DAY, DAY, 1)


def test_one_frame_of_dividends_for_all_tickers(spark):
    frame = spark.createDataFrame([(dt.datetime(2024, 2, 28), 0.5, "AAA3")], "Date timestamp, Dividends double, ticker string")
    assert same(vendor.normalize_vendor_dividends(frame, "UTC"), vendor.normalize_vendor_dividends([frame], "UTC"))


def test_daily_run_fails_on_a_failed_check(spark, run):
    high_below_low = (DAY, "AAA3", 10.0, 5.0, 9.0, 10.0, 10.0, 1)
    with pytest.raises(RuntimeError, match="maxima_maior_igual_minima"):
        loads.run_daily(spark, run, bars(spark, high_below_low), empty(spark, DIVIDENDS), DAY)
