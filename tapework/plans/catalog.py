"""Registered queries: every operator and model over the given tables.

Each query takes ``(spark, sf_dir)``. Logarithms, volatilities and means of fractions are rounded to
six digits here, because engines add floats in different orders; the operators do not round.
"""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tapework.functions import scalar as S
from tapework.functions.aggregates import annualize, arg_max, arg_min
from tapework.operators import facts, indicators, quality, sets, staging
from tapework.operators.dimensions import company_keys, dim_calendar, dim_company, keyed_companies
from tapework.plans import exploratory, loads, reports
from tapework.plans.refresh import refresh
from tapework.plans.warehouse import Warehouse
from tapework.schemas import DIVIDENDS, EXCHANGE_ZONE, PRICE_COLUMNS, QUOTES, VENDOR_METRICS
from tapework.session import fresh_path, stage_table
from tapework.sinks.folding import fold_months, read_folded
from tapework.sinks.layers import create_layer, materialize
from tapework.sinks.partitioned import write_dividends, write_quotes
from tapework.sinks.versions import YEAR, Store
from tapework.sources import market
from tapework.sources.generated import calendar_days, days_between, literal_mapping
from tapework.sources.raw import (
    read_companies, read_raw_dividends, read_raw_quotes, with_partition_bounds,
)
from tapework.sources.vendor import normalize_vendor_bars, normalize_vendor_dividends, wide_column

TICKER = "NATION_13"
START, END = dt.date(1997, 1, 1), dt.date(1998, 12, 31)
TODAY = dt.date(2001, 8, 1)
YEARS = range(1995, 2002)

VOLATILITIES = [f"volatilidade_{n}d" for n in indicators.VOLATILITY_WINDOWS]
# Columns that engines may compute with a different last digit; all others are exact.
INEXACT = [
    "retorno_log", *VOLATILITIES, *[f"{c}_anual" for c in VOLATILITIES],
    "volatilidade_media_30d", "retorno_medio_diario", "volatilidade_periodo", "volatilidade",
]


def rounded(df, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in INEXACT if c in df.columns})


def _calendar(spark):
    return calendar_days(spark, market.CALENDAR_START, market.CALENDAR_END)


def nations(spark, d):
    return Warehouse(market.nation_quotes(spark, d), market.nation_dividends(spark, d),
                     market.nation_companies(spark, d), _calendar(spark))


def parts(spark, d):
    return Warehouse(market.part_quotes(spark, d), market.part_dividends(spark, d),
                     market.part_companies(spark, d), _calendar(spark))


def landed(spark, d):
    """The nation warehouse over a written raw layer, for plans that read it several times."""
    house = nations(spark, d)
    house.raw_quotes = stage_table(house.raw_quotes, "raw_cotacoes")
    house.raw_dividends = stage_table(house.raw_dividends, "raw_dividendos")
    return house


def ticker_list(spark, d):
    """Configured tickers: the names of the 25 nations."""
    return sorted(r.n_name for r in market.table(spark, d, "nation").select("n_name").collect())


# --- sources ---------------------------------------------------------------------------------------

def read_quotes_in_period(spark, d):
    return with_partition_bounds(written_quotes("year")(spark, d), START, END).select(QUOTES.names)


def read_companies_seed(spark, d):
    path = fresh_path(spark, "seed")
    market.nation_companies(spark, d).write.csv(path, header=True, quoteAll=True, escape='"')
    return read_companies(spark, path)


def wide_bars(spark, d, tickers):
    """Raw quotes in the vendor's wide shape."""
    names = {v: k for k, v in VENDOR_METRICS.items()}
    raw = market.nation_quotes(spark, d)
    # distinct (data, ticker) rows: max picks the only value
    wide = raw.groupBy("data").pivot("ticker", tickers).agg(
        *[F.max(c).alias(names[c]) for c in names])
    return wide.select(F.col("data").cast("timestamp").alias("Date"), *[
        F.col(f"`{t}_{m}`").alias(wide_column(t, m)) for t in tickers for m in VENDOR_METRICS])


def vendor_bars(spark, d):
    tickers = ticker_list(spark, d)
    return normalize_vendor_bars(wide_bars(spark, d, tickers), tickers)


def vendor_bars_flat(spark, d):
    """Flat single-ticker form over all quotes, taken as one instrument: the largest value per day."""
    daily = market.nation_quotes(spark, d).groupBy("data").agg(
        *[F.max(c).alias(m) for m, c in VENDOR_METRICS.items()])
    return normalize_vendor_bars(daily.withColumnRenamed("data", "Date"), ["WORLD"])


def vendor_dividends(spark, d):
    events = market.nation_dividends(spark, d)
    # the vendor stamps an ex-date as midnight on the exchange's clock
    stamped = events.select(
        F.convert_timezone(F.lit(EXCHANGE_ZONE), F.current_timezone(), F.col("data_ex").cast("timestamp_ntz"))
        .cast("timestamp").alias("Date"),
        F.col("valor_dividendo").alias("Dividends"), "ticker")
    halves = [stamped.where(F.month("Date") <= 6), stamped.where(F.month("Date") > 6)]
    return normalize_vendor_dividends(halves)


def calendar_of_data(spark, d):
    """Calendar over all years the orders and shipments touch."""
    ordered = market.table(spark, d, "orders").select(F.col("o_orderdate").alias("ts"))
    shipped = market.table(spark, d, "lineitem").select(F.col("l_shipdate").alias("ts"))
    bounds = ordered.unionByName(shipped).agg(
        F.to_date(F.date_trunc("year", F.min("ts"))).alias("first"),
        F.date_sub(F.add_months(F.to_date(F.date_trunc("year", F.max("ts"))), 12), 1).alias("last"))
    return dim_calendar(days_between(bounds, "first", "last"))


def sector_volume_literal(spark, d):
    """Sector volume with the mapping of the 25 nations written out as literals instead of the dimension."""
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    mapping = {f"NATION_{i}": regions[i % 5] for i in range(25)}
    return exploratory.sector_volume(market.nation_quotes(spark, d), literal_mapping(spark, mapping))


# --- sinks -----------------------------------------------------------------------------------------

def written_quotes(granularity):
    def query(spark, d):
        path = fresh_path(spark, "cotacoes")
        landing = stage_table(market.nation_quotes(spark, d).select(QUOTES.names), "landing")
        write_quotes(landing, path, granularity)
        return read_raw_quotes(spark, path, granularity)
    return query


def folded_months(spark, d, days=None):
    """Raw layer by day, its closed months folded; ``days`` are then written again with doubled volumes and folded."""
    daily, folded = fresh_path(spark, "cotacoes"), fresh_path(spark, "meses")
    landing = stage_table(market.nation_quotes(spark, d).select(QUOTES.names), "landing")
    write_quotes(landing, daily)
    fold_months(spark, daily, folded, END)
    if days:
        write_quotes(landing.where(F.col("data").between(*days)).withColumn("volume", F.col("volume") * 2), daily)
        fold_months(spark, daily, folded, END)
    return read_folded(spark, daily, folded)


def written_dividends(spark, d):
    path = fresh_path(spark, "dividendos")
    write_dividends(stage_table(market.nation_dividends(spark, d).select(DIVIDENDS.names), "landing"), path)
    return read_raw_dividends(spark, path)


def rewritten_year(spark, d):
    """Dividends after the incremental mode rewrote one year with doubled amounts."""
    path = fresh_path(spark, "dividendos")
    events = stage_table(market.nation_dividends(spark, d).select(DIVIDENDS.names), "landing")
    write_dividends(events, path)
    doubled = events.withColumn("valor_dividendo", F.col("valor_dividendo") * 2)
    write_dividends(doubled, path, {END.year})
    return read_raw_dividends(spark, path)


def materialized_layers(spark, d):
    """Company dimension as a view of one layer and, from it, as a table of another."""
    house = nations(spark, d)
    layer, root = f"marts_{uuid.uuid4().hex[:8]}", fresh_path(spark, "warehouse")
    for _ in range(2):
        create_layer(spark, layer, root)
    view = materialize(house.company, "staging", "empresa", "view")
    table = materialize(view, layer, "dim_empresa", "table", root)
    return table


def refreshed_table(spark, d):
    """A table written with all companies, then refreshed without one sector: the second content."""
    company = stage_table(nations(spark, d).company, "companies")
    layer, root = f"marts_{uuid.uuid4().hex[:8]}", fresh_path(spark, "warehouse")
    create_layer(spark, layer, root)
    materialize(company, layer, "dim_empresa", "table", root)
    return materialize(company.where(F.col("setor") != "AMERICA"), layer, "dim_empresa", "table", root)


def permanent_view(layer, name):
    """A view that a daily run left behind, read by another session of the same catalog."""
    def query(spark, d):
        run = _filled_run(spark, d)
        refresh(spark, run)
        names = {"raw": run.raw_layer, "staging": run.layers[0], "marts": run.layers[1]}
        return spark.newSession().table(f"{names[layer]}.{name}")
    return query


def changed_write(spark, d):
    """Rows that differ after one year was written again with doubled volumes."""
    path = fresh_path(spark, "cotacoes")
    quotes = stage_table(market.nation_quotes(spark, d).select(QUOTES.names), "landing")
    write_quotes(quotes, path, "month")
    before = stage_table(read_raw_quotes(spark, path, "month"), "before")
    write_quotes(quotes.where(F.year("data") == 1997).withColumn("volume", F.col("volume") * 2), path, "month")
    return sets.partition_difference(before, read_raw_quotes(spark, path, "month"), ["ano", "mes"])


def idempotent_write(spark, d):
    """Rows that differ after writing the same quotes twice: none."""
    path = fresh_path(spark, "cotacoes")
    quotes = stage_table(market.nation_quotes(spark, d).select(QUOTES.names), "landing")
    write_quotes(quotes, path, "month")
    before = stage_table(read_raw_quotes(spark, path, "month"), "before")
    write_quotes(quotes, path, "month")
    return sets.partition_difference(before, read_raw_quotes(spark, path, "month"), ["ano", "mes"])


# --- joins, aggregates, sets -----------------------------------------------------------------------

def rejected(spark, d):
    """Rows lost when the dimensions know only part of the world: one region, one half of the days."""
    house = landed(spark, d)
    known = dim_company(house.companies.where(F.col("setor") == "AMERICA"))
    days = house.calendar.where(F.col("data") < F.lit(END))
    return facts.rejected_rows(house.stg_quotes, known, days)


def rejected_counts(spark, d):
    return rejected(spark, d).groupBy("motivo").agg(F.count(F.lit(1)).alias("linhas"))


def dividends_without_session(spark, d):
    """Ex-dates on which the ticker has no bar."""
    return market.nation_dividends(spark, d).select("ticker", F.col("data_ex").alias("data")).join(
        market.nation_quotes(spark, d).select("ticker", "data"), ["ticker", "data"], "left_anti")


def first_last_price(spark, d):
    price, day = F.col("fechamento_ajustado"), F.col("data")
    return market.nation_quotes(spark, d).groupBy("ticker").agg(
        arg_min(price, day).alias("primeiro"), arg_max(price, day).alias("ultimo"))


def distinct_counts(spark, d):
    raw = market.nation_quotes(spark, d)
    return raw.agg(F.count_distinct("ticker").alias("tickers"), F.count_distinct("data").alias("datas"))


def period_volatility(spark, d):
    house = nations(spark, d)
    grouped = house.daily.groupBy("empresa_id").agg(
        annualize(F.stddev_samp("retorno_log")).alias("volatilidade"))
    return rounded(grouped)


def missing_tickers(spark, d):
    """Companies without any dividend."""
    return reports.tickers_without_data(
        market.nation_dividends(spark, d), market.nation_companies(spark, d))


def missing_on_last_day(spark, d):
    """Companies without a bar on the last day of all."""
    quotes = stage_table(market.nation_quotes(spark, d).select("ticker", "data"), "pregoes")
    last = quotes.agg(F.max("data").alias("data"))
    return reports.tickers_without_data(quotes.join(last, "data"), market.nation_companies(spark, d))


def half_of_the_union(spark, d):
    """Dividends compared with the frames of the first half-years only: those of the second differ."""
    events = stage_table(market.nation_dividends(spark, d).select(DIVIDENDS.names), "landing")
    first = events.where(F.month("data_ex") <= 6).withColumn("Date", F.col("data_ex").cast("timestamp"))
    frame = first.select("Date", F.col("valor_dividendo").alias("Dividends"), "ticker")
    return sets.multiset_difference(events, normalize_vendor_dividends(frame, "UTC"))


def per_ticker_union(spark, d):
    """Per-ticker dividend frames stacked again and compared with the whole: no row differs."""
    return sets.multiset_difference(
        market.nation_dividends(spark, d).select(DIVIDENDS.names), vendor_dividends(spark, d))


# --- windows ---------------------------------------------------------------------------------------

def daily_part(*columns):
    def query(spark, d):
        picked = nations(spark, d).daily.select("empresa_id", "data", *columns)
        return rounded(picked)
    return query


def raw_returns(spark, d):
    return exploratory.raw_returns(stage_table(
        market.nation_quotes(spark, d).select("ticker", "data", "fechamento"), "fechamentos"))


# --- models ----------------------------------------------------------------------------------------

def daily_indicators(house):
    return lambda spark, d: rounded(house(spark, d).daily)


def indicator_summary(house):
    return lambda spark, d: rounded(house(spark, d).summary)


def dividend_yield(house):
    return lambda spark, d: rounded(house(spark, d).yields)


def fractional_yield(spark, d):
    """The yield of amounts in hundredths."""
    house = nations(spark, d)
    cents = house.dividends.withColumn("valor_dividendo", F.col("valor_dividendo") / 100)
    result = indicators.dividend_yield(house.quotes, cents, house.calendar)
    return result.withColumns({c: F.round(c, 6) for c in ("dividendos_12m", "dy_12m")})


def dividend_yield_by_join(spark, d):
    house = nations(spark, d)
    return indicators.dividend_yield_by_join(house.quotes_view, house.dividends, house.calendar)


# --- reports ---------------------------------------------------------------------------------------

def ranges_of_all(spark, d):
    house = nations(spark, d)
    return reports.date_range(facts.with_date(house.quotes_view, house.calendar))


def range_of_ticker(spark, d):
    house = nations(spark, d)
    return reports.date_range(facts.with_date(house.quotes_view, house.calendar), house.company, TICKER)


def period_options(spark, d):
    house = nations(spark, d)
    return reports.period_starts(facts.with_date(house.quotes_view, house.calendar), house.company)


def on_daily(report, *args):
    """Reports of one ticker compute only that ticker's series."""
    def query(spark, d):
        house = nations(spark, d)
        if TICKER in args:
            house = house.of_ticker(TICKER)
        return rounded(report(house.daily, house.company, *args))
    return query


def on_quotes(report, start, end, *args):
    """For reports that need only the price and date of the daily mart: the period reaches the raw scan
    through the day keys, and nothing is written in between."""
    def query(spark, d):
        house = nations(spark, d)
        house.raw_quotes = with_partition_bounds(house.raw_quotes, start, end)
        dated = facts.with_date(house.quotes_view, house.calendar)
        return rounded(report(dated, house.company, start, end, *args))
    return query


def on_yields(report, *args):
    def query(spark, d):
        house = nations(spark, d)
        if TICKER in args:
            house = house.of_ticker(TICKER)
        return rounded(report(house.yields, house.company, *args))
    return query


def quotes_coverage(spark, d):
    house = landed(spark, d)
    return reports.coverage_report(house.raw_quotes, house.companies)


def dividends_coverage(spark, d):
    house = landed(spark, d)
    return reports.coverage_report(house.raw_dividends, house.companies, "data_ex")


def summary_card(spark, d):
    return rounded(reports.summary_card(nations(spark, d).of_ticker(TICKER).summary, TICKER))


def _comparison(spark, d):
    house = nations(spark, d)
    return reports.comparison_table(house.summary, house.company, house.yields)


def comparison_table(spark, d):
    return rounded(_comparison(spark, d))


def best_worst(spark, d):
    table = stage_table(_comparison(spark, d), "comparison")
    flags = reports.best_worst_flags(table)
    inexact = F.col("metrica") == "volatilidade_media_30d"
    return flags.withColumn("valor", F.when(inexact, F.round("valor", 6)).otherwise(F.col("valor")))


def comparison_text(spark, d):

    return reports.comparison_text(comparison_table(spark, d))


def warehouse_check(spark, d):
    house = landed(spark, d)
    return reports.warehouse_check(
        house.raw_quotes, house.stg_quotes, house.quotes, house.company, house.calendar)


def acceptance(block):
    def query(spark, d):
        house = nations(spark, d)
        return reports.acceptance_blocks(
            house.company, house.daily, house.yields, house.summary, TICKER)[block]
    return query


# --- checks ----------------------------------------------------------------------------------------

def null_volumes(spark, d):
    house = nations(spark, d)
    return quality.not_null(house.stg_quotes, "volume")


def repeated_dates(spark, d):
    """Dates that more than one ticker traded on."""
    return quality.unique(nations(spark, d).stg_quotes, "data")


def repeated_keys(spark, d):
    """Several shipments of one part on one day break the key (part, day)."""
    lines = market.table(spark, d, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("data"))
    return quality.unique_combination(lines, ["l_partkey", "data"])


def unlisted_tickers(spark, d):
    """Quotes of the nations left out of the accepted values on purpose."""
    known = market.table(spark, d, "nation").where(F.col("n_regionkey") < 3).select(F.col("n_name").alias("ticker"))
    return quality.accepted_values(nations(spark, d).stg_quotes, "ticker", known)


def orphans(spark, d):
    """Quotes whose ticker never paid a dividend."""
    house = landed(spark, d)
    return quality.relationships(house.stg_quotes, "ticker", house.raw_dividends, "ticker")


def orphans_of_a_day(spark, d):
    """Quotes whose ticker paid no dividend on the last ex-date of all."""
    house = landed(spark, d)
    last = house.raw_dividends.agg(F.max("data_ex").alias("data_ex"))
    return quality.relationships(house.stg_quotes, "ticker", house.raw_dividends.join(last, "data_ex"), "ticker")


def filled_first_return(spark, d):
    """First sessions of marts whose missing returns were filled with 0 on purpose."""
    return quality.first_session_return(nations(spark, d).daily.fillna(0.0, ["retorno_simples"]))


def raw_range_violations(spark, d):
    """The range rule on raw bars, where partial bars break it."""
    return quality.violates(
        market.nation_quotes(spark, d), "fato_cotacoes_diarias", "fechamento_dentro_do_range")


def first_session(spark, d):
    return quality.first_session_return(nations(spark, d).daily)


def suffixed(spark, d):
    """Quotes that still carry the suffix: those of every other year, put back on purpose."""
    raw = market.nation_quotes(spark, d)
    odd = F.col("ano") % 2 == 1
    marked = raw.withColumn("ticker", F.when(odd, S.with_suffix(F.col("ticker"))).otherwise(F.col("ticker")))
    found = quality.leftover_suffix(marked)
    return found.select("data", "ticker", S.without_suffix(F.col("ticker")).alias("limpo"))


def check_report(spark, d):
    house = landed(spark, d)
    return house.checks(ticker_list(spark, d))


# --- loads -----------------------------------------------------------------------------------------

def loaded(mode, start=None, end=None, years=loads.HISTORY_YEARS):
    def query(spark, d):
        path = fresh_path(spark, "cotacoes")
        source = stage_table(market.nation_quotes(spark, d).select(QUOTES.names), "landing")
        loads.load_quotes(source, path, mode, TODAY, start, end, "month", years)
        return read_raw_quotes(spark, path, "month")
    return query


def reloaded(granularity, start, end):
    """All history loaded, then days inside its months again with doubled volumes; no other day changes."""
    def query(spark, d):
        path = fresh_path(spark, "cotacoes")
        source = stage_table(market.nation_quotes(spark, d).select(QUOTES.names), "landing")
        loads.load_quotes(source, path, "inicial", TODAY, granularity=granularity, years=None)
        again = source.withColumn("volume", F.col("volume") * 2)
        if start == end:
            loads.load_quotes(again, path, "diario", start, granularity=granularity)
        else:
            loads.load_quotes(again, path, "range", TODAY, start, end, granularity)
        return read_raw_quotes(spark, path, granularity)
    return query


def vendor_to_raw(spark, d):
    """The wide vendor frame of all tickers, loaded into the raw layer."""
    tickers, path = ticker_list(spark, d), fresh_path(spark, "cotacoes")
    loads.ingest_vendor_bars(wide_bars(spark, d, tickers), tickers, path, "inicial", TODAY, years=None)
    return read_raw_quotes(spark, path)


def loaded_dividends(spark, d):
    """All dividends, then the current year's again for every ticker, with doubled amounts."""
    path = fresh_path(spark, "dividendos")
    source = stage_table(market.nation_dividends(spark, d).select(DIVIDENDS.names), "landing")
    loads.load_dividends(source, path, "inicial", TODAY)
    doubled = source.withColumn("valor_dividendo", F.col("valor_dividendo") * 2)
    loads.load_dividends(doubled, path, "incremental", TODAY)
    return read_raw_dividends(spark, path)


def _filled_run(spark, d, last=TODAY):
    """A warehouse with its raw layer loaded up to ``last`` and nothing refreshed yet."""
    seed = fresh_path(spark, "seed")
    market.nation_companies(spark, d).write.csv(seed, header=True, quoteAll=True, escape='"')
    run = loads.DailyRun(
        fresh_path(spark, "run"), seed, ticker_list(spark, d), market.CALENDAR_START, market.CALENDAR_END,
        granularity="month", layers=(f"staging_{(own := uuid.uuid4().hex[:8])}", f"marts_{own}"), raw_layer=f"raw_{own}")
    quotes = stage_table(market.nation_quotes(spark, d).select(QUOTES.names), "landing")
    dividends = stage_table(market.nation_dividends(spark, d).select(DIVIDENDS.names), "landing")
    loads.load_quotes(quotes, run.quotes_path, "range", last, market.CALENDAR_START, last, "month")
    loads.load_dividends(dividends, run.dividends_path, "inicial", TODAY)
    return run


def daily_run(spark, d):
    """All history loaded, then one daily run; the check report of that run."""
    run = _filled_run(spark, d)
    quotes = stage_table(market.nation_quotes(spark, d).select(QUOTES.names), "landing")
    dividends = stage_table(market.nation_dividends(spark, d).select(DIVIDENDS.names), "landing")
    return loads.run_daily(spark, run, quotes, dividends, TODAY)


#: The day from which the continued marts are refreshed, and the days of the late correction.
CONTINUED = dt.date(2001, 3, 1)
CORRECTED = dt.date(1999, 3, 10), dt.date(1999, 3, 24)


def _landing(spark, d):
    return (stage_table(market.nation_quotes(spark, d).select(QUOTES.names), "landing"),
            stage_table(market.nation_dividends(spark, d).select(DIVIDENDS.names), "landing"))


def _published(run, spark):
    return Store(spark, f"{run.root}/marts", run.layers[1])


def _run_until(spark, d, last):
    """A warehouse refreshed in full over the history up to ``last``."""
    run = _filled_run(spark, d, last)
    refresh(spark, run)
    return run


def continued(table, doubled=False):
    """Marts of the history before ``CONTINUED``, then continued with the days from it on; with ``doubled`` dividends of the
    current year."""
    def query(spark, d):
        run = _run_until(spark, d, CONTINUED - dt.timedelta(days=1))
        quotes, dividends = _landing(spark, d)
        if doubled:
            current = F.year("data_ex") == TODAY.year
            loads.load_dividends(dividends.withColumn("valor_dividendo", F.when(current, F.col("valor_dividendo") * 2).otherwise(
                F.col("valor_dividendo"))), run.dividends_path, "incremental", TODAY)
        loads.run_range(spark, run, quotes, CONTINUED, TODAY)
        return _shown(spark, run, table)
    return query


def corrected(table):
    """Marts of all history, then refreshed from a late correction on: doubled bars and volumes of two weeks."""
    def query(spark, d):
        run = _run_until(spark, d, TODAY)
        quotes, _ = _landing(spark, d)
        doubled = quotes.withColumns({c: F.col(c) * 2 for c in (*PRICE_COLUMNS, "volume")})
        loads.run_range(spark, run, doubled, *CORRECTED)
        return _shown(spark, run, table)
    return query


def _shown(spark, run, table):
    rows = _published(run, spark).table(table)
    return rounded(rows.drop(YEAR))


def after_failed_run(spark, d):
    """What readers see of the fact after a run whose checks failed: the rows of the run before."""
    run = _run_until(spark, d, TODAY)
    quotes, _ = _landing(spark, d)
    broken = quotes.withColumn("maxima", F.when(F.col("maxima") > 0, F.col("minima") - 1))
    try:
        loads.run_range(spark, run, broken, *CORRECTED)
    except RuntimeError:
        return _shown(spark, run, "fato_cotacoes_diarias")
    raise AssertionError("a run with broken bars was published")


def stable_keys(spark, d):
    """Keys of the companies when those of one region came a run later than the others."""
    every = market.nation_companies(spark, d)
    first = stage_table(company_keys(every.where(F.col("setor") != "AMERICA")), "keys")
    return keyed_companies(every, company_keys(every, first))


def on_published(report, *args, mart="mart_indicadores_diarios"):
    """Reports that read the published marts: folders of other years and, for joins by company, exchanges are spared."""
    def query(spark, d):
        store = _published(_run_until(spark, d, TODAY), spark)
        return rounded(report(store.table(mart), store.table("dim_empresa"), *args))
    return query


def house_table(name):
    return lambda spark, d: getattr(nations(spark, d), name)


QUERIES = {
    # sources
    "s1_raw_quotes": lambda s, d: market.nation_quotes(s, d),
    "s1_quotes_in_period": read_quotes_in_period,
    "s2_raw_dividends": lambda s, d: market.nation_dividends(s, d),
    "s3_companies": read_companies_seed,
    "s4_vendor_bars": vendor_bars,
    "s5_vendor_bars_flat": vendor_bars_flat,
    "s6_vendor_dividends": vendor_dividends,
    "s8_sector_volume_literal": sector_volume_literal,
    # sinks
    "k1_write_quotes": written_quotes("day"),
    "k1_write_quotes_by_month": written_quotes("month"),
    "k1_folded_months": folded_months,
    "k1_folded_correction": lambda s, d: folded_months(s, d, (dt.date(1997, 5, 15), dt.date(1997, 7, 9))),
    "k2_write_dividends": written_dividends,
    "k2_rewrite_one_year": rewritten_year,
    "k3_k4_layers": materialized_layers,
    "k3_refreshed_table": refreshed_table,
    "k3_staging_view": permanent_view("staging", "stg_cotacoes"),
    "k3_dividend_view": permanent_view("marts", "fato_dividendos"),
    "k5_q10_idempotent_write": idempotent_write,
    "k5_changed_write": changed_write,
    # projections and filters
    "p1_stg_quotes": house_table("stg_quotes"),
    "p2_stg_dividends": house_table("stg_dividends"),
    "p3_drop_empty_bars": lambda s, d: staging.drop_empty_bars(
        market.nation_quotes(s, d).withColumns({
            c: F.when(F.dayofmonth("data") % 7 != 0, F.col(c)) for c in PRICE_COLUMNS})),
    "p10_period_options": period_options,
    # dimensions, facts, marts
    "d1_dim_company": house_table("company"),
    "d1_stable_keys": stable_keys,
    "d2_dim_calendar": calendar_of_data,
    "m1_fact_quotes": house_table("quotes_view"),
    "m2_fact_dividends": house_table("dividends"),
    "m3_daily_indicators": daily_indicators(nations),
    "m3_daily_indicators_parts": daily_indicators(parts),
    "m4_indicator_summary": indicator_summary(nations),
    "m4_indicator_summary_parts": indicator_summary(parts),
    "m5_dividend_yield": dividend_yield(nations),
    "m5_dividend_yield_parts": dividend_yield(parts),
    "m5_dividend_yield_by_join": dividend_yield_by_join,
    "m5_fractional_amounts": fractional_yield,
    # joins, aggregates, sets
    "j8_dividends_without_session": dividends_without_session,
    "a3_first_last_price": first_last_price,
    "a7_distinct_counts": distinct_counts,
    "a9_period_volatility": period_volatility,
    "j11_u3_missing_tickers": missing_tickers,
    "j11_missing_on_last_day": missing_on_last_day,
    "u2_u4_per_ticker_union": per_ticker_union,
    "u2_u4_half_of_the_union": half_of_the_union,
    # windows
    "w1_simple_return": daily_part("retorno_simples"),
    "w2_log_return": daily_part("retorno_log"),
    "w3_cumulative_return": daily_part("retorno_acumulado"),
    "w4_moving_averages": daily_part(*[f"media_movel_{n}d" for n in indicators.AVERAGE_WINDOWS]),
    "w5_window_fill": daily_part(*[f"pregoes_janela_{n}d" for n in indicators.AVERAGE_WINDOWS]),
    "w6_w7_volatility": daily_part(*[c for v in VOLATILITIES for c in (v, f"{v}_anual")]),
    "w8_w9_drawdown": daily_part("pico_historico", "drawdown"),
    "w12_raw_returns": raw_returns,
    # exploratory
    "g1_coverage": lambda s, d: exploratory.coverage_by_ticker(market.nation_quotes(s, d)),
    "g2_yearly_amplitude": lambda s, d: exploratory.yearly_amplitude(market.nation_quotes(s, d)),
    "g3_sector_volume": lambda s, d: exploratory.sector_volume_series(
        market.nation_quotes(s, d), market.nation_companies(s, d)),
    "g4_extreme_returns": lambda s, d: exploratory.extreme_returns(stage_table(
        market.nation_quotes(s, d).select("ticker", "data", "fechamento"), "fechamentos")),
    "g5_session_gaps": lambda s, d: exploratory.session_gaps(stage_table(
        market.nation_quotes(s, d).select("ticker", "data"), "pregoes")),
    "g6_amplitude_matrix": lambda s, d: exploratory.amplitude_matrix(
        market.nation_quotes(s, d), YEARS),
    # reports
    "r1_list_tickers": lambda s, d: reports.list_tickers(nations(s, d).company),
    "r2_date_range": ranges_of_all,
    "r2_date_range_of_ticker": range_of_ticker,
    "r3_indicator_series": on_daily(reports.indicator_series, TICKER, START, END),
    "r3_published_series": on_published(reports.indicator_series, TICKER, START, END),
    "r5_published_returns": on_published(reports.period_returns, START, END),
    "r6_published_risk": on_published(reports.risk_return, START, END),
    "r4_published_yield": on_published(reports.yield_series, TICKER, START, END, mart="mart_dividend_yield"),
    "r4_yield_series": on_yields(reports.yield_series, TICKER, START, END),
    "r5_period_returns": on_quotes(
        reports.period_returns, START, END),
    "r6_risk_return": on_daily(
        reports.risk_return, START, END),
    "r7_quotes_coverage": quotes_coverage,
    "r7_dividends_coverage": dividends_coverage,
    "r8_current_yield": on_yields(reports.current_yield, TICKER),
    "r8_yield_ranking": on_yields(reports.yield_ranking),
    "r9_summary_card": summary_card,
    "r10_comparison_table": comparison_table,
    "r10_comparison_text": comparison_text,
    "r11_best_worst_flags": best_worst,
    "r12_warehouse_check": warehouse_check,
    "r13_companies": acceptance("dim_empresa"),
    "r13_counts": acceptance("contagens"),
    "r13_latest_yield": acceptance("yield_recente"),
    "r13_latest_sessions": acceptance("pregoes_recentes"),
    "r13_partial_windows": acceptance("janela_parcial"),
    "r13_summary": acceptance("resumo"),
    "r14_price_chart": on_daily(reports.price_chart, TICKER, START, END),
    "r14_return_chart": on_daily(
        reports.return_chart, TICKER, START, END),
    "r14_volatility_chart": on_daily(
        reports.volatility_chart, TICKER, START, END),
    "r14_drawdown_chart": on_daily(reports.drawdown_chart, TICKER, START, END),
    "r14_yield_chart": on_yields(reports.yield_chart, TICKER, START, END),
    "r14_comparison_chart": on_quotes(reports.comparison_chart, START, END, True),
    "r14_comparison_percent_chart": on_quotes(
        reports.comparison_chart, START, END, False),
    "r14_risk_return_chart": on_daily(
        reports.risk_return_chart, START, END),
    "r14_ranking_chart": on_yields(reports.ranking_chart),
    # checks
    "q1_null_volumes": null_volumes,
    "q2_repeated_dates": repeated_dates,
    "q3_repeated_keys": repeated_keys,
    "q4_unlisted_tickers": unlisted_tickers,
    "q5_orphans": orphans,
    "q5_orphans_of_a_day": orphans_of_a_day,
    "q6_close_not_positive": lambda s, d: quality.price_not_positive(market.nation_quotes(s, d)),
    "q7_filled_first_return": filled_first_return,
    "q6_raw_range_violations": raw_range_violations,
    "q7_first_session_return": first_session,
    "q8_rejected_rows": rejected,
    "q8_rejected_counts": rejected_counts,
    "q9_leftover_suffix": suffixed,
    "q11_check_report": check_report,
    # loads
    "l1_full_history": loaded("inicial"),
    "l1_all_history": loaded("inicial", years=None),
    "l1_vendor_to_raw": vendor_to_raw,
    "l2_one_day": loaded("diario"),
    "l2_one_day_of_a_filled_month": reloaded("month", dt.date(1997, 5, 15), dt.date(1997, 5, 15)),
    "l3_range": loaded("range", START, END),
    "l3_range_inside_filled_months": reloaded("year", dt.date(1997, 5, 15), dt.date(1997, 7, 9)),
    "l4_dividends_current_year": loaded_dividends,
    "l5_daily_run": daily_run,
    "l5_continued_indicators": continued("mart_indicadores_diarios"),
    "l5_continued_yield": continued("mart_dividend_yield", doubled=True),
    "l5_corrected_indicators": corrected("mart_indicadores_diarios"),
    "l5_corrected_summary": corrected("mart_indicadores_resumo"),
    "k1_after_failed_run": after_failed_run,
}
