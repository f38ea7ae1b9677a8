"""Parameterised read queries over the marts, and the frames behind each chart and table."""

from pyspark.sql import functions as F

from tapework.functions.aggregates import arg_max, arg_min, sample_volatility
from tapework.functions.scalar import percent, percent_text, period_start, ratio
from tapework.operators.facts import with_company_id, with_date
from tapework.operators.sets import missing_keys
from tapework.sinks.versions import YEAR

# Months of each period option (None = whole series).
PERIODS = {"6 meses": 6, "1 ano": 12, "2 anos": 24, "Tudo": None}
# Metrics of the comparison table; True where a larger value is better.
METRIC_DIRECTION = {
    "retorno_acumulado_total": True,
    "max_drawdown": True,
    "volatilidade_media_30d": False,
    "dy_atual": True,
}


def list_tickers(company):
    return company.select("ticker").orderBy(F.asc_nulls_last("ticker"))


def date_range(daily, company=None, ticker=None):
    """First and last session, of one ticker or of the whole series."""
    if ticker is not None:
        daily = _of_ticker(daily, company, ticker)
    return daily.agg(F.min("data").alias("minimo"), F.max("data").alias("maximo"))


def _of_ticker(mart, company, ticker):
    return with_company_id(mart, company.where(F.col("ticker") == ticker))


def _within(mart, start, end):
    """Rows of a period; a published mart also skips the folders of other years."""
    rows = mart.where(F.col("data").between(start, end))
    return rows.where(F.col(YEAR).between(start.year, end.year)).drop(YEAR) if YEAR in mart.columns else rows


def period_starts(daily, company):
    """Start of every period option per ticker, counted back from its last session."""
    ranges = daily.groupBy("empresa_id").agg(F.min("data").alias("minimo"), F.max("data").alias("maximo"))
    options = F.array(*[
        F.struct(F.lit(option).alias("periodo"),
                 period_start(F.col("maximo"), F.col("minimo"), months).alias("inicio"))
        for option, months in PERIODS.items()
    ])
    return with_company_id(ranges, company, "ticker").select("ticker", "maximo", F.inline(options))


def indicator_series(daily, company, ticker, start, end):
    """All indicator columns of one ticker in a period; NULLs of the first sessions stay."""
    series = _within(_of_ticker(daily, company, ticker), start, end)
    return series.select([c for c in daily.columns if c != YEAR]).orderBy(F.asc_nulls_last("data"))


def yield_series(yields, company, ticker, start, end):
    return _within(_of_ticker(yields, company, ticker), start, end).select(
        "data", "fechamento_bruto", "dividendos_12m", "dy_12m").orderBy(F.asc_nulls_last("data"))


def period_returns(daily, company, start, end):
    """Return of every ticker since its first session inside the period, as fraction and base 100.

    The first price comes from an aggregation of the filtered rows, so no ticker is sorted.
    """
    period = _within(daily, start, end).select("empresa_id", "data", "fechamento_ajustado")
    anchor = period.groupBy("empresa_id").agg(F.min_by("fechamento_ajustado", "data").alias("base"))
    factor = ratio(F.col("fechamento_ajustado"), F.col("base"))
    return with_company_id(period.join(anchor, "empresa_id"), company, "ticker").select(
        "ticker", "data", (factor - 1).alias("retorno_janela"), (factor * 100).alias("base_100"),
    ).orderBy(F.asc_nulls_last("ticker"), F.asc_nulls_last("data"))


def risk_return(daily, company, start, end):
    """Return and annualised volatility of the period per ticker, recomputed on its rows."""
    price, day = F.col("fechamento_ajustado"), F.col("data")
    grouped = _within(daily, start, end).groupBy("empresa_id").agg(
        arg_max(price, day).alias("ultimo"), arg_min(price, day).alias("primeiro"),
        sample_volatility("retorno_log").alias("volatilidade_periodo"))
    return with_company_id(grouped, company, "ticker").select(
        "ticker", (ratio(F.col("ultimo"), F.col("primeiro")) - 1).alias("retorno_periodo"),
        "volatilidade_periodo").orderBy(F.asc_nulls_last("ticker"))


def coverage_report(df, expected, date="data"):
    """Rows, tickers, dates and expected tickers without a row, in one row."""
    totals = df.agg(
        F.count(F.lit(1)).alias("linhas"), F.min(date).alias("data_min"), F.max(date).alias("data_max"))
    per_ticker = df.where(F.col("ticker").isNotNull()).groupBy("ticker").agg(F.lit(1).alias("com_dado"))
    seen = per_ticker.agg(F.count(F.lit(1)).alias("n"))
    missing = missing_keys(expected, df, "ticker").agg(F.count(F.lit(1)).alias("n"))
    return totals.select(
        "linhas", seen.scalar().alias("tickers"), "data_min", "data_max",
        missing.scalar().alias("tickers_sem_dado"))


def tickers_without_data(df, expected):
    return missing_keys(expected, df, "ticker").orderBy(F.asc_nulls_last("ticker"))


def current_yield(yields, company, ticker):
    """Yield on the last session of one ticker; no row when it has none."""
    return _of_ticker(yields, company, ticker).orderBy(F.desc_nulls_last("data")).limit(1).select("dy_12m")


def _latest_yield(yields, name):
    return yields.groupBy("empresa_id").agg(arg_max(F.col("dy_12m"), F.col("data")).alias(name))


def yield_ranking(yields, company):
    return with_company_id(_latest_yield(yields, "dy_12m"), company, "ticker").select(
        "ticker", "dy_12m").orderBy(F.desc_nulls_last("dy_12m"), F.asc_nulls_last("ticker"))


def summary_card(summary, ticker):
    return summary.where(F.col("ticker") == ticker)


def comparison_table(summary, company, yields):
    """Whole-history summary with name and latest yield; a ticker without yield keeps NULL."""
    named = with_company_id(summary, company, "nome")
    return named.join(_latest_yield(yields, "dy_atual"), "empresa_id", "left").select(
        "ticker", "nome", "retorno_acumulado_total", "max_drawdown", "volatilidade_media_30d",
        "dy_atual", "total_pregoes").orderBy(F.asc_nulls_last("ticker"))


def best_worst_flags(table, directions=None):
    """One row per ticker and metric with its value and a mark for the best or worst value.

    The extremes are an aggregation of one row per metric joined back, so the tickers of a metric
    never meet in one task. NULL is never marked; when all values are equal all are best.
    """
    directions = directions or METRIC_DIRECTION
    values = table.select("ticker", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metrica"), F.col(m).cast("double").alias("valor")) for m in directions])))
    larger_is_better = F.col("metrica").isin([m for m, up in directions.items() if up])
    extremes = values.groupBy("metrica").agg(F.max("valor").alias("maior"), F.min("valor").alias("menor"))
    best = F.when(larger_is_better, F.col("maior")).otherwise(F.col("menor"))
    worst = F.when(larger_is_better, F.col("menor")).otherwise(F.col("maior"))
    mark = F.when(F.col("valor") == best, "melhor").when(F.col("valor") == worst, "pior")
    # one row per metric
    return values.join(F.broadcast(extremes), "metrica").select(
        "ticker", "metrica", "valor", mark.alias("marca"))


def comparison_text(table):
    """Comparison table with percentages as text."""
    return table.select(
        "ticker", "nome",
        *[percent_text(F.col(c)).alias(c) for c in (
            "retorno_acumulado_total", "max_drawdown", "volatilidade_media_30d")],
        percent_text(F.col("dy_atual"), 2).alias("dy_atual"),
        F.col("total_pregoes").cast("string").alias("total_pregoes"))


def row_counts(tables):
    """Number of rows of each named table in one row."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tabela"), "n")
              for name, df in tables.items()]
    combined = counts[0]
    for count in counts[1:]:
        combined = combined.unionByName(count)
    return combined.agg(*[
        F.max(F.when(F.col("tabela") == name, F.col("n"))).alias(name) for name in tables])


def warehouse_check(raw, staged, fact, company, calendar):
    """Rows, date range and extra figures of every layer, one row per layer."""
    def layer(name, df, tickers=None, volume=None):
        dated = "data" in df.columns
        none_date, none = F.lit(None).cast("date"), F.lit(None)
        return df.agg(
            F.lit(name).alias("camada"),
            F.count(F.lit(1)).alias("linhas"),
            (F.min("data") if dated else none_date).alias("min_data"),
            (F.max("data") if dated else none_date).alias("max_data"),
            (tickers if tickers is not None else none.cast("long")).alias("tickers"),
            (volume if volume is not None else none.cast("double")).alias("volume_medio"),
        )

    parts = [
        layer("raw.cotacoes", raw, tickers=F.count_distinct("ticker")),
        layer("staging.stg_cotacoes", staged),
        layer("marts.fato_cotacoes_diarias", with_date(fact, calendar),
              volume=F.round(F.avg("volume"), 2)),
        layer("marts.dim_empresa", company),
        layer("marts.dim_tempo", calendar),
    ]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined


def acceptance_blocks(company, daily, yields, summary, ticker, rows=5):
    """Six read-outs for a person to look at, by name."""
    # the ticker's id as a scalar subquery: more than one row is an error
    ticker_id = company.where(F.col("ticker") == ticker).select("empresa_id").scalar()
    own = daily.where(F.col("empresa_id") == ticker_id)
    latest = _of_ticker(yields, company, ticker).orderBy(F.desc_nulls_last("data")).limit(1)
    return {
        "dim_empresa": company.orderBy(F.asc_nulls_last("empresa_id")),
        "contagens": row_counts({"diarios": daily, "yield": yields, "resumo": summary}),
        "yield_recente": latest.select(
            "data", "fechamento_bruto", "dividendos_12m", percent(F.col("dy_12m"), 2).alias("dy_pct")),
        "pregoes_recentes": own.orderBy(F.desc_nulls_last("data")).limit(rows).select(
            "data",
            percent(F.col("retorno_simples"), 3).alias("ret_pct"),
            F.round("media_movel_30d", 2).alias("mm30"),
            percent(F.col("volatilidade_30d_anual"), 1).alias("vol30_anual_pct"),
            percent(F.col("drawdown"), 1).alias("drawdown_pct")),
        "janela_parcial": own.orderBy(F.asc_nulls_last("data")).limit(rows).select(
            "data", F.round("media_movel_200d", 2).alias("mm200"), "pregoes_janela_200d"),
        "resumo": summary.select(
            "ticker",
            percent(F.col("max_drawdown"), 1).alias("max_dd_pct"),
            percent(F.col("retorno_acumulado_total"), 1).alias("ret_acum_pct"),
            "total_pregoes").orderBy(F.asc_nulls_last("ticker")),
    }


def _scaled(df, keys, columns):
    return df.select(*keys, *[(F.col(c) * 100).alias(c) for c in columns])


def price_chart(daily, company, ticker, start, end):
    series = indicator_series(daily, company, ticker, start, end)
    return series.select("data", "fechamento_ajustado", "media_movel_7d", "media_movel_30d",
                         "media_movel_90d", "media_movel_200d")


def return_chart(daily, company, ticker, start, end):
    return _scaled(indicator_series(daily, company, ticker, start, end), ["data"], ["retorno_acumulado"])


def volatility_chart(daily, company, ticker, start, end):
    return _scaled(indicator_series(daily, company, ticker, start, end), ["data"], [
        "volatilidade_30d_anual", "volatilidade_90d_anual", "volatilidade_252d_anual"])


def drawdown_chart(daily, company, ticker, start, end):
    return _scaled(indicator_series(daily, company, ticker, start, end), ["data"], ["drawdown"])


def yield_chart(yields, company, ticker, start, end):
    return _scaled(yield_series(yields, company, ticker, start, end), ["data"], ["dy_12m"])


def comparison_chart(daily, company, start, end, base_100):
    returns = period_returns(daily, company, start, end)
    if base_100:
        return returns.select("ticker", "data", F.col("base_100").alias("valor"))
    return returns.select("ticker", "data", (F.col("retorno_janela") * 100).alias("valor"))


def risk_return_chart(daily, company, start, end):
    return _scaled(risk_return(daily, company, start, end), ["ticker"], [
        "volatilidade_periodo", "retorno_periodo"])


def ranking_chart(yields, company):
    """Latest yield per ticker in ascending order, in percent and as a label."""
    return yield_ranking(yields, company).orderBy(F.asc_nulls_last("dy_12m"), F.asc_nulls_last("ticker")).select(
        "ticker", (F.col("dy_12m") * 100).alias("dy_pct"), percent_text(F.col("dy_12m"), 2).alias("rotulo"))
