"""Daily indicators, their per-ticker summary, and the trailing dividend yield."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapework.functions import series as W
from tapework.functions.aggregates import annualize, arg_max
from tapework.functions.scalar import ratio
from tapework.operators.facts import with_company_id, with_date
from tapework.operators.layout import MAX_ROWS_PER_KEY, over_series, split_hot

# Window lengths in sessions, dividend window in days.
AVERAGE_WINDOWS = (7, 30, 90, 200)
VOLATILITY_WINDOWS = (30, 90, 252)
YIELD_DAYS = 365

# Days per block of the trailing sum; longer than the window so that an event reaches two blocks.
YIELD_BLOCK_DAYS = 1461
# Days per block of the interval join: an event reaches few blocks, and a block holds few sessions of a company.
JOIN_BLOCK_DAYS = 182

PRICE = "fechamento_ajustado"
YIELD_KEYS = ["empresa_id", "tempo_id", "data", "fechamento_bruto"]


def indicator_columns(base, w, averages=AVERAGE_WINDOWS, volatilities=VOLATILITY_WINDOWS):
    """Returns, moving averages, volatilities and drawdown of the adjusted close.

    All windows share one partitioning and order, so Spark plans one exchange and one sort.
    """
    marked = base.withColumns({
        "_previous": W.previous(PRICE, w),
        "_first": w.first(PRICE),
        "_position": F.row_number().over(w.ordered),
        "pico_historico": w.running_max(PRICE),
    })
    returns = marked.withColumns({
        "retorno_simples": W.simple_return(PRICE, "_previous"),
        "retorno_log": W.log_return(PRICE, "_previous"),
        "retorno_acumulado": W.cumulative_return(PRICE, "_first"),
        "drawdown": W.drawdown(PRICE, "pico_historico"),
        **{f"pregoes_janela_{n}d": W.window_fill(n, "_position") for n in averages},
    })
    rolled = W.rolling(
        returns, w, "_position",
        means={PRICE: {f"media_movel_{n}d": n for n in averages}},
        deviations={"retorno_log": {f"volatilidade_{n}d": n for n in volatilities}},
    )
    rolled = rolled.withColumns(
        {f"volatilidade_{n}d_anual": annualize(F.col(f"volatilidade_{n}d")) for n in volatilities})
    return rolled.select(
        "empresa_id", "tempo_id", "data", PRICE, "volume",
        "retorno_simples", "retorno_log", "retorno_acumulado",
        *[f"media_movel_{n}d" for n in averages],
        *[f"pregoes_janela_{n}d" for n in averages],
        *[c for n in volatilities for c in (f"volatilidade_{n}d", f"volatilidade_{n}d_anual")],
        "pico_historico", "drawdown",
        *[c for c in base.columns if c == "_own"],
    )


def daily_indicators(fact, calendar, max_rows=MAX_ROWS_PER_KEY):
    """One row per company and session with 24 columns; ``fact`` should be a written table, since
    it is read once for the row counts and once for the windows."""
    base = with_date(fact.select("empresa_id", "tempo_id", PRICE, "volume"), calendar)
    # one row more than the longest window: the oldest return in it looks one price further back
    halo = max(*AVERAGE_WINDOWS, *VOLATILITY_WINDOWS) + 1
    return over_series(base, indicator_columns, key="empresa_id", date="data", halo=halo,
                       carry=(PRICE,), max_rows=max_rows)


def indicator_summary(daily, company):
    """One row per company over its whole history."""
    grouped = daily.groupBy("empresa_id").agg(
        F.min("drawdown").alias("max_drawdown"),
        arg_max(F.col("retorno_acumulado"), F.col("data")).alias("retorno_acumulado_total"),
        F.avg("volatilidade_30d_anual").alias("volatilidade_media_30d"),
        F.avg("retorno_simples").alias("retorno_medio_diario"),
        F.avg("volume").alias("volume_medio"),
        F.min("data").alias("primeiro_pregao"),
        F.max("data").alias("ultimo_pregao"),
        F.count(F.lit(1)).alias("total_pregoes"),
    )
    return with_company_id(grouped, company, "ticker").select(
        "empresa_id", "ticker", *grouped.columns[1:])


def dividend_yield(quotes_fact, dividends_fact, calendar, max_rows=MAX_ROWS_PER_KEY):
    """Dividends of the trailing 365 days over the raw close; 0 when there are none.

    Dividends are summed per company and day. The trailing sum changes only on an event's day and 365 days later, so it
    is taken at those days, each time anew over the 365 days before, and every quote looks up the last change in one
    ordered window over blocks of days instead of a range join. An event is copied only into the blocks its 365 days
    touch. Repeated quotes form one row with the sum of all copies.
    """
    block = F.floor(F.col("day") / YIELD_BLOCK_DAYS)
    last_block = F.floor((F.col("day") + (YIELD_DAYS - 1)) / YIELD_BLOCK_DAYS)
    events = (
        with_date(dividends_fact, calendar)
        .groupBy("empresa_id", F.unix_date("data").alias("day"))
        .agg(F.sum("valor_dividendo").alias("amount"))
        .withColumn("block", F.explode(F.sequence(block, last_block)))
    )

    def placed(fact):
        dated = with_date(fact, calendar).withColumnRenamed("fechamento", "fechamento_bruto")
        return dated.withColumn("day", F.unix_date("data")).withColumn("block", block)

    columns = quotes_fact.select("empresa_id", "tempo_id", "fechamento")
    ordinary, hot, hot_ids = split_hot(columns, "empresa_id", max_rows)
    group = ["empresa_id", "block"]
    # copies are few here and merge after the window, in the partitions it already has
    single = placed(ordinary).withColumn("copies", F.lit(1))
    result = _trailing_sum(single, events, group).groupBy(*YIELD_KEYS, "block").agg(
        F.sum("dividendos_12m").alias("dividendos_12m")).drop("block")
    if hot is not None:
        # copies collapse before the shuffle; the other quotes do not depend on each other, so they
        # are spread over as many parts as the company needs, and each part gets all the events
        parts = hot_ids.select("empresa_id", F.ceil(F.col("_rows") / max_rows).alias("parts"))
        collapsed = placed(hot).groupBy(*YIELD_KEYS, "day", "block").agg(F.count(F.lit(1)).alias("copies"))
        spread = collapsed.join(parts, "empresa_id").withColumn(
            "part", F.pmod(F.xxhash64(*YIELD_KEYS), F.col("parts"))).drop("parts")
        copied = events.join(parts, "empresa_id").withColumn(
            "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
        result = result.unionByName(_trailing_sum(spread, copied, [*group, "part"]).drop("block"))
    return result.withColumn("dy_12m", ratio(F.col("dividendos_12m"), F.col("fechamento_bruto")))


def _trailing_sum(quotes, events, group):
    changes = events.select(
        *group, F.inline(F.array(F.struct("day", "amount"), F.struct((F.col("day") + YIELD_DAYS).alias("day"), F.lit(None).cast("double").alias("amount")))),
    )
    year = Window.partitionBy(*group).orderBy("day").rangeBetween(-(YIELD_DAYS - 1), Window.currentRow)
    totals = changes.select(*group, "day", F.coalesce(F.sum("amount").over(year), F.lit(0.0)).alias("total"))
    merged = quotes.unionByName(totals, allowMissingColumns=True)
    # the change of a day comes before its quotes
    upto = Window.partitionBy(*group).orderBy("day", F.col("total").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.coalesce(F.last("total", ignorenulls=True).over(upto), F.lit(0.0))
    return (
        merged.withColumn("dividendos_12m", total * F.col("copies"))
        .where(F.col("copies").isNotNull())
        .select(*YIELD_KEYS, "block", "dividendos_12m")
    )


def dividend_yield_by_join(quotes_fact, dividends_fact, calendar, block_days=JOIN_BLOCK_DAYS, max_rows=MAX_ROWS_PER_KEY):
    """The same yield as a left interval join, kept as the independent check of ``dividend_yield``.

    Both sides are cut into blocks of days per company: a session lies in one block, an event is copied to the blocks that
    its 365 days reach, and only rows of one block meet. Repeated sessions are collapsed and events summed per day before
    the shuffle, so a block holds at most ``block_days`` + 364 events; sessions of a block above ``max_rows`` are spread over
    parts that each get those events.
    """
    def block(day):
        return F.floor(day / block_days)

    dated = with_date(quotes_fact.select("empresa_id", "tempo_id", "fechamento"), calendar)
    sessions = dated.withColumnRenamed("fechamento", "fechamento_bruto").groupBy(*YIELD_KEYS).agg(
        F.count(F.lit(1)).alias("copies")).withColumn("block", block(F.unix_date("data")))
    events = (
        with_date(dividends_fact, calendar)
        .groupBy("empresa_id", F.unix_date("data").alias("day")).agg(F.sum("valor_dividendo").alias("amount"))
        .withColumn("block", F.explode(F.sequence(block(F.col("day")), block(F.col("day") + (YIELD_DAYS - 1)))))
    )
    keys = ["empresa_id", "block"]
    parts = sessions.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / max_rows).alias("parts")).where(F.col("parts") > 1)
    some = F.coalesce("parts", F.lit(1).cast("long"))
    spread = sessions.join(parts, keys, "left").withColumn("part", F.pmod(F.xxhash64(*YIELD_KEYS), some)).drop("parts")
    copied = events.join(parts, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), some - 1))).drop("parts")
    since = F.unix_date("data") - F.col("day")
    # a session and its events meet in one task, where their sum is taken before the last shuffle
    pairs = spread.join(copied.withColumnsRenamed({c: f"_{c}" for c in (*keys, "part")}), (
        (F.col("empresa_id") == F.col("_empresa_id")) & (F.col("block") == F.col("_block")) & (F.col("part") == F.col("_part"))
        & since.between(0, YIELD_DAYS - 1)), "left")
    summed = pairs.groupBy(*YIELD_KEYS, "copies").agg(F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total"))
    result = summed.select(*YIELD_KEYS, (F.col("total") * F.col("copies")).alias("dividendos_12m"))
    return result.withColumn("dy_12m", ratio(F.col("dividendos_12m"), F.col("fechamento_bruto")))
