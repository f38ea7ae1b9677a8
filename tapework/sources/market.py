"""Market tables derived from the order tables, in the shape the raw layer has.

``nation_*``: one instrument per nation, few long series. ``part_*``: one instrument per part, as
many series as there are parts. Prices and dividends are whole numbers, so that sums are exact.
Rows are aggregated before they meet the names, and only needed columns are read.
"""

import datetime as dt

from pyspark.sql import functions as F

from tapework.schemas import RAW_DIVIDENDS, RAW_QUOTES

# Calendar of the derived tables.
CALENDAR_START = dt.date(1995, 1, 1)
CALENDAR_END = dt.date(2001, 12, 31)


# Columns of the order tables that are used; a fixed schema spares a job per read to infer it.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey long, c_nationkey int",
    "supplier": "s_suppkey long, s_nationkey int",
    "part": "p_partkey long, p_name string, p_brand string, p_type string",
    "orders": "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
}


def table(spark, sf_dir, name):
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def nation_companies(spark, sf_dir):
    region = F.col("r_name")
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("ticker"), F.col("n_name").alias("nome"), region.alias("setor"),
            region.alias("subsetor"), region.alias("segmento"))
    )


def _bars(grouped):
    """Turn aggregated (ticker, data, open, high, low, close, n) into raw quotes with the gaps a
    vendor feed has: zero or missing open/high/low on day 29, no volume on day 13, no adjusted close
    on day 31, and an adjustment by half before 1998."""
    day = F.dayofmonth("data")
    close = F.floor("close").cast("double")
    return grouped.select(
        "data", "ticker",
        F.when(day == 29, F.lit(0.0)).otherwise(F.floor("open").cast("double")).alias("abertura"),
        F.when(day == 29, F.lit(0.0)).otherwise(F.floor("high").cast("double")).alias("maxima"),
        F.when(day != 29, F.floor("low").cast("double")).alias("minima"),
        close.alias("fechamento"),
        F.when(day == 31, F.lit(None)).when(F.col("data") < F.lit(dt.date(1998, 1, 1)), close * 0.5)
        .otherwise(close).alias("fechamento_ajustado"),
        F.when(day != 13, F.col("n") * 100).alias("volume"),
        F.year("data").alias("ano"), F.month("data").alias("mes"), day.alias("dia"),
    ).select(RAW_QUOTES.names)


def _events(grouped):
    return grouped.select(
        "data_ex", "ticker", F.floor("amount").cast("double").alias("valor_dividendo"),
        F.year("data_ex").alias("ano"),
    ).select(RAW_DIVIDENDS.names)


def _names(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("ticker"))


def nation_quotes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("data"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    grouped = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "data")
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    return _bars(grouped.join(_names(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")))


def _returned_items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(
        "l_suppkey", "l_partkey", F.to_date("l_shipdate").alias("data_ex"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("paid"))


def nation_dividends(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    grouped = (
        _returned_items(spark, sf_dir)
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "data_ex").agg(F.max("paid").alias("amount"))
    )
    return _events(grouped.join(_names(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")))


def _part_ticker(key):
    return F.concat(F.lit("P"), F.lpad(F.col(key).cast("string"), 12, "0"))


def part_companies(spark, sf_dir):
    ticker = _part_ticker("p_partkey")
    return table(spark, sf_dir, "part").select(
        ticker.alias("ticker"), F.col("p_name").alias("nome"), F.col("p_brand").alias("setor"),
        F.col("p_type").alias("subsetor"), F.col("p_brand").alias("segmento"))


def part_quotes(spark, sf_dir):
    grouped = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", F.to_date("l_shipdate").alias("data"))
        .agg(
            F.min("l_extendedprice").alias("open"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.max("l_extendedprice").alias("close"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    return _bars(grouped.withColumn("ticker", _part_ticker("l_partkey")))


def part_dividends(spark, sf_dir):
    grouped = _returned_items(spark, sf_dir).groupBy("l_partkey", "data_ex").agg(
        F.max("paid").alias("amount"))
    return _events(grouped.withColumn("ticker", _part_ticker("l_partkey")))
