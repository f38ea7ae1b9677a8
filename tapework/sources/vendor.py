"""Vendor files as landed → long canonical rows."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapework.functions.scalar import with_suffix, without_suffix
from tapework.operators.staging import canonical, drop_empty_bars
from tapework.schemas import DIVIDENDS, EXCHANGE_SUFFIX, EXCHANGE_ZONE, QUOTES, VENDOR_METRICS

WIDE_SEPARATOR = "|"


def wide_column(ticker, metric):
    """Name of the column holding one metric of one ticker in the wide vendor frame."""
    return f"{ticker}{EXCHANGE_SUFFIX}{WIDE_SEPARATOR}{metric}"


def normalize_vendor_bars(wide, tickers):
    """Wide vendor frame (``Date`` plus one column per ticker and metric) → one row per ticker and
    day. The values of a ticker already share a row, so stacking them needs no shuffle.

    With one ticker the vendor sends flat metric columns; with more that is an error.
    """
    if not tickers:
        raise ValueError("no tickers")
    if set(VENDOR_METRICS) <= set(wide.columns):
        if len(tickers) != 1:
            raise ValueError("flat vendor columns with more than one ticker")
        stacked = wide.withColumn("ticker", with_suffix(F.lit(tickers[0])))
    else:
        bars = [
            F.struct(
                with_suffix(F.lit(ticker)).alias("ticker"),
                *[F.col(f"`{wide_column(ticker, metric)}`").alias(metric) for metric in VENDOR_METRICS],
            )
            for ticker in tickers
        ]
        stacked = wide.select("Date", F.inline(F.array(*bars)))
    named = stacked.withColumn("ticker", without_suffix(F.col("ticker")))
    return drop_empty_bars(canonical(named, QUOTES, {"Date": "data", **VENDOR_METRICS}))


def local_date(instant, zone=EXCHANGE_ZONE):
    """Calendar date of an instant on the exchange's clock, whatever the session's zone is."""
    wall = F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))
    return wall.cast("date")


def normalize_vendor_dividends(frames, zone=EXCHANGE_ZONE):
    """Frames (``Date`` instant, ``Dividends``, ``ticker``) as dividend rows: one frame of all tickers, or
    a list of them to be stacked."""
    if isinstance(frames, DataFrame):
        frames = [frames]
    if not frames:
        raise ValueError("no tickers")
    stacked = reduce(lambda a, b: a.unionByName(b), frames)
    dated = stacked.withColumn("data_ex", local_date(F.col("Date"), zone))
    return canonical(dated, DIVIDENDS, {"Dividends": "valor_dividendo"})
