"""Exploratory read queries over the raw layer."""

from pyspark.sql import functions as F

from tapework.functions.scalar import month_start, ratio
from tapework.functions.series import previous
from tapework.operators.facts import with_company
from tapework.operators.layout import MAX_ROWS_PER_KEY, over_series

# Fixed value: rows of each extreme.
TOP = 20


def coverage_by_ticker(raw):
    return raw.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("pregoes"),
        F.min("data").alias("primeiro_pregao"),
        F.max("data").alias("ultimo_pregao"),
    ).orderBy(F.asc_nulls_last("ticker"))


def yearly_amplitude(raw):
    """Largest (high − low) / low per ticker and year; rows without a positive low are left out."""
    spread = (F.col("maxima") - F.col("minima")) / F.col("minima")
    return (
        raw.where(F.col("minima") > 0).groupBy("ticker", "ano")
        .agg(F.max(spread).alias("amplitude_maxima"))
        .orderBy(F.asc_nulls_last("ticker"), F.asc_nulls_last("ano"))
    )


def amplitude_matrix(raw, years):
    """Ticker × year matrix of the yearly amplitude for a fixed list of years."""
    spread = (F.col("maxima") - F.col("minima")) / F.col("minima")
    return raw.where(F.col("minima") > 0).groupBy("ticker").pivot("ano", list(years)).agg(F.max(spread))


def sector_volume(raw, sectors):
    """Mean of all known volumes per sector and month (not a mean of ticker means); rows are added up
    per ticker before they meet the sectors."""
    per_ticker = raw.where(F.col("volume").isNotNull()).groupBy("ticker", "ano", "mes").agg(
        F.sum(F.col("volume").cast("double")).alias("total"), F.count(F.lit(1)).alias("n"))
    mean = F.sum("total") / F.sum("n")
    return (
        with_company(per_ticker, sectors, "setor")
        .groupBy("setor", "ano", "mes").agg(mean.alias("volume_medio"))
        .orderBy(F.asc_nulls_last("setor"), F.asc_nulls_last("ano"), F.asc_nulls_last("mes"))
    )


def sector_volume_series(raw, sectors):
    """The same with the month as a date, for plotting."""
    return sector_volume(raw, sectors).withColumn("data", month_start(F.col("ano"), F.col("mes")))


def raw_returns(raw, max_rows=MAX_ROWS_PER_KEY):
    """Daily change of the raw close in percent."""
    def build(df, w):
        before = df.withColumn("_before", previous("fechamento", w))
        change = ratio(F.col("fechamento") - F.col("_before"), F.col("_before")) * 100
        return before.withColumn("retorno_pct", change).drop("_before")

    bars = raw.select("ticker", "data", "fechamento")
    return over_series(bars, build, key="ticker", date="data", halo=1, max_rows=max_rows)


def extreme_returns(raw, top=TOP, max_rows=MAX_ROWS_PER_KEY):
    """The largest rises and falls over all tickers; ties go by ticker and date."""
    returns = raw_returns(raw, max_rows).where(F.col("retorno_pct").isNotNull())

    def pick(tag, order):
        best = returns.orderBy(order, F.asc_nulls_last("ticker"), F.asc_nulls_last("data")).limit(top)
        return best.select(F.lit(tag).alias("extremo"), "ticker", "data", "fechamento", "retorno_pct")

    both = pick("alta", F.desc("retorno_pct")).unionByName(pick("queda", F.asc("retorno_pct")))
    return both.orderBy("extremo", F.desc_nulls_last("retorno_pct"), F.asc_nulls_last("ticker"), F.asc_nulls_last("data"))


def session_gaps(raw):
    """Days on which some ticker traded and this one did not.

    A ticker's set of days is at most the calendar, so it travels as one array; the missing days come
    out of an array difference instead of pairing all days with all tickers and joining them back.
    """
    # one row holding the distinct days, bounded by the calendar
    sessions = raw.agg(F.collect_set("data").alias("sessions"))
    traded = raw.groupBy("ticker").agg(F.collect_set("data").alias("traded"))
    missing = F.array_except(sessions.scalar(), F.col("traded"))
    return (
        traded.where(F.col("ticker").isNotNull())
        .select(F.explode(missing).alias("data"), "ticker").orderBy(F.asc_nulls_last("data"), F.asc_nulls_last("ticker"))
    )
