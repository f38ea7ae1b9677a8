"""Marts continued from a day on: what earlier sessions must leave behind, and how new ones are computed from it.

The state of a company is its last sessions, as many as the longest window can look back on, with its first price and its
running peak. Averages come from exact totals and deviations from their own rows (``functions.series.rolling``), so new
sessions computed after the state's have the bits of a full rebuild.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapework.functions import series as W
from tapework.operators.indicators import AVERAGE_WINDOWS, PRICE, VOLATILITY_WINDOWS, daily_indicators
from tapework.operators.layout import MAX_ROWS_PER_KEY

#: Sessions a company leaves behind: the longest window, and the price that its oldest return looks back to.
HALO = max(*AVERAGE_WINDOWS, *VOLATILITY_WINDOWS) + 1
STATE = ["empresa_id", "tempo_id", PRICE, "volume", "primeiro", "pico"]


def state_after(sessions, state=None, halo=HALO):
    """State of every company after ``sessions`` (of the quote fact) that follow ``state``: its last ``halo`` sessions, each
    with the company's first price and peak.

    Companies without new sessions keep theirs. The cut to the last sessions takes a day at a time: days are counted per
    company, and a day is kept while fewer than ``halo`` sessions come after it.
    """
    columns = ["empresa_id", "tempo_id", PRICE, "volume"]
    rows = sessions.select(columns)
    totals = rows.groupBy("empresa_id").agg(F.min_by(PRICE, "tempo_id").alias("primeiro"), F.max(PRICE).alias("pico"))
    if state is not None:
        rows = rows.unionByName(state.select(columns))
        known = state.groupBy("empresa_id").agg(F.min("primeiro").alias("_primeiro"), F.max("pico").alias("_pico"))
        totals = known.join(totals, "empresa_id", "full").select(
            "empresa_id", F.coalesce("_primeiro", "primeiro").alias("primeiro"), F.greatest("pico", "_pico").alias("pico"))
    days = rows.groupBy("empresa_id", "tempo_id").agg(F.count(F.lit(1)).alias("_n"))
    later = Window.partitionBy("empresa_id").orderBy(F.col("tempo_id").desc()).rowsBetween(Window.unboundedPreceding, -1)
    kept = days.withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0))).where(F.col("_later") < halo).select("empresa_id", "tempo_id")
    return rows.join(kept, ["empresa_id", "tempo_id"], "left_semi").join(totals, "empresa_id").select(STATE)


def continued_indicators(state, sessions, calendar, max_rows=MAX_ROWS_PER_KEY):
    """Daily indicators of ``sessions`` that follow ``state``. Windows run over the state's sessions and the new ones;
    first price and peak, which look back further, come from the state."""
    columns = ["empresa_id", "tempo_id", PRICE, "volume"]
    daily = daily_indicators(state.select(columns).unionByName(sessions.select(columns)), calendar, max_rows)
    known = state.groupBy("empresa_id").agg(
        F.max("pico").alias("_pico"), F.min("primeiro").alias("_primeiro"), F.max("tempo_id").alias("_upto"))
    joined = daily.join(known, "empresa_id", "left").where(F.col("_upto").isNull() | (F.col("tempo_id") > F.col("_upto")))
    resumed = F.col("_upto").isNotNull()
    peak = F.greatest("pico_historico", "_pico")
    return joined.withColumns({
        "retorno_acumulado": F.when(resumed, W.cumulative_return(PRICE, "_primeiro")).otherwise(F.col("retorno_acumulado")),
        "pico_historico": peak,
    }).withColumn("drawdown", W.drawdown(PRICE, "pico_historico")).select(daily.columns)


def yearly_summary(daily):
    """What a company's summary needs of each year of the daily mart; years merge in ``merged_summary``."""
    last = F.when(F.col("retorno_acumulado").isNotNull(), F.col("tempo_id"))
    return daily.groupBy("empresa_id", F.floor(F.col("tempo_id") / 10_000).cast("int").alias("_year")).agg(
        F.max("tempo_id").alias("tempo_id"),
        F.min("drawdown").alias("drawdown"), F.max(last).alias("ultimo_id"), F.max_by("retorno_acumulado", last).alias("ultimo_retorno"),
        F.sum("volatilidade_30d_anual").alias("vol"), F.count("volatilidade_30d_anual").alias("n_vol"),
        F.sum("retorno_simples").alias("ret"), F.count("retorno_simples").alias("n_ret"),
        F.sum("volume").alias("vol_neg"), F.count("volume").alias("n_neg"),
        F.min("data").alias("primeiro"), F.max("data").alias("ultimo"), F.count(F.lit(1)).alias("n")).drop("_year")


def merged_summary(years, company):
    """The summary of ``indicators.indicator_summary`` from its yearly parts."""
    return years.groupBy("empresa_id").agg(
        F.min("drawdown").alias("max_drawdown"), F.max_by("ultimo_retorno", "ultimo_id").alias("retorno_acumulado_total"),
        F.try_divide(F.sum("vol"), F.sum("n_vol")).alias("volatilidade_media_30d"),
        F.try_divide(F.sum("ret"), F.sum("n_ret")).alias("retorno_medio_diario"),
        F.try_divide(F.sum("vol_neg").cast("double"), F.sum("n_neg")).alias("volume_medio"),
        F.min("primeiro").alias("primeiro_pregao"), F.max("ultimo").alias("ultimo_pregao"), F.sum("n").alias("total_pregoes"),
    ).join(company.select("empresa_id", "ticker"), "empresa_id").select(
        "empresa_id", "ticker", "max_drawdown", "retorno_acumulado_total", "volatilidade_media_30d", "retorno_medio_diario",
        "volume_medio", "primeiro_pregao", "ultimo_pregao", "total_pregoes")
