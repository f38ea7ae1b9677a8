"""Company and calendar dimensions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapework.functions import scalar as S
from tapework.schemas import DIM_COMPANY
from tapework.session import stage_table


def number_rows(df, order, name):
    """Dense 1-based row number over the order of column ``order`` (unique by contract, NULL last).

    The sorted rows are written once, each with its place inside its sorted part, and parts are shifted by the rows
    before them, so no task sees them all.
    """
    order = F.col(order).asc_nulls_last()
    place = F.monotonically_increasing_id()
    placed = stage_table(
        df.orderBy(order)
        .withColumn("_part", F.shiftright(place, 33))
        .withColumn("_place", place.bitwiseAND(F.lit(2**33 - 1))),
        "numbered",
    )
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # one row per sorted part, so its count is bounded by the partitions of the sort
    shifts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(before, F.lit(0)).alias("_shift"))
    return (
        placed.join(shifts, "_part")
        .withColumn(name, F.col("_shift") + F.col("_place") + 1)
        .select(*df.columns, name)
    )


def dim_company(companies):
    """Surrogate key by ticker order; rebuilt in full on every run."""
    return number_rows(companies, "ticker", "empresa_id").select(DIM_COMPANY.names)


def company_keys(companies, known=None):
    """``(ticker, empresa_id)`` of every ticker ever seen: those of the map ``known`` keep their key, also when their company
    is gone, and new ones follow behind the highest key in ticker order."""
    tickers = companies.select("ticker")
    if known is None:
        return number_rows(tickers, "ticker", "empresa_id")
    fresh = number_rows(tickers.join(known, "ticker", "left_anti"), "ticker", "empresa_id")
    # one row: the highest key given so far
    highest = known.agg(F.coalesce(F.max("empresa_id"), F.lit(0)).alias("_highest"))
    shifted = fresh.select("ticker", (F.col("empresa_id") + highest.scalar()).alias("empresa_id"))
    return known.select("ticker", "empresa_id").unionByName(shifted)


def keyed_companies(companies, keys):
    """The company dimension with the keys of a stored map."""
    return companies.join(keys, "ticker").select(DIM_COMPANY.names)


def dim_calendar(days):
    """Calendar attributes of a relation with one ``data`` column."""
    day = F.col("data")
    return days.select(
        S.date_key(day).alias("tempo_id"),
        "data",
        F.year(day).cast("long").alias("ano"),
        F.month(day).cast("long").alias("mes"),
        F.dayofmonth(day).cast("long").alias("dia"),
        S.weekday(day).alias("dia_semana"),
        F.quarter(day).cast("long").alias("trimestre"),
        S.month_name(day).alias("nome_mes"),
        S.weekday_name(day).alias("nome_dia_semana"),
        S.is_weekend(day).alias("eh_fim_semana"),
        S.is_month_start(day).alias("eh_inicio_mes"),
        S.is_month_end(day).alias("eh_fim_mes"),
    )
