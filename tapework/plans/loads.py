"""Load modes of the raw layer and the daily run over all layers."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import functions as F

from tapework.operators import quality
from tapework.plans.refresh import refresh
from tapework.plans.reports import coverage_report
from tapework.schemas import DIVIDENDS, QUOTES, assert_schema
from tapework.session import stage_table
from tapework.sinks.partitioned import write_dividends, write_quotes
from tapework.sources.vendor import normalize_vendor_bars

# Years of history of a full load, counted as 365 days, unless the caller asks for others.
HISTORY_YEARS = 5


def load_interval(mode, today, start=None, end=None, years=HISTORY_YEARS):
    """Inclusive dates of a load mode: ``inicial``, ``diario`` or ``range``. ``years`` is the history
    of ``inicial``; None is all of it, and then there is no first date."""
    if mode == "inicial":
        return (today - dt.timedelta(days=365 * years) if years is not None else None), today
    if mode == "diario":
        return today, today
    if mode != "range":
        raise ValueError(f"unknown mode {mode!r}")
    if start is None or end is None:
        raise ValueError("range needs a start and an end")
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    return start, end


def load_quotes(source, path, mode, today, start=None, end=None, granularity="day", years=HISTORY_YEARS):
    """Write the source rows of the interval, day by day over what is stored; returns the partitions
    written (0 without sessions)."""
    assert_schema(source, QUOTES)
    first, last = load_interval(mode, today, start, end, years)
    rows = source.where(F.col("data") <= F.lit(last))
    if first is not None:
        rows = rows.where(F.col("data") >= F.lit(first))
    if not quality.leftover_suffix(rows).isEmpty():
        raise ValueError("tickers still carry the exchange suffix")
    return write_quotes(rows, path, granularity)


def ingest_vendor_bars(wide, tickers, path, mode, today, start=None, end=None, granularity="day", years=HISTORY_YEARS):
    """Vendor frame → contract → raw layer; returns the partitions written and the one-row summary of
    rows, tickers, dates and expected tickers without a row."""
    bars = stage_table(normalize_vendor_bars(wide, tickers), "vendor-bars")
    written = load_quotes(bars, path, mode, today, start, end, granularity, years)
    expected = wide.sparkSession.createDataFrame([(t,) for t in tickers], "ticker string")
    return written, coverage_report(bars, expected)


def load_dividends(source, path, mode, today):
    """``inicial`` rewrites every year, ``incremental`` the current one."""
    if mode not in ("inicial", "incremental"):
        raise ValueError(f"unknown mode {mode!r}")
    assert_schema(source, DIVIDENDS)
    return write_dividends(source, path, {today.year} if mode == "incremental" else None)


@dataclass
class DailyRun:
    """Places and parameters of a daily run."""

    root: str
    companies_csv: str
    tickers: list
    calendar_start: dt.date
    calendar_end: dt.date
    granularity: str = "day"
    layers: tuple = ("staging", "marts")
    raw_layer: str = "raw"

    @property
    def quotes_path(self):
        return f"{self.root}/raw/cotacoes"

    @property
    def dividends_path(self):
        return f"{self.root}/raw/dividendos"


def run_daily(spark, run, quotes_source, dividends_source, today):
    """Load one day, continue all models from it, check them, then show them; a failed check fails the run and leaves what
    readers see."""
    load_quotes(quotes_source, run.quotes_path, "diario", today, granularity=run.granularity)
    load_dividends(dividends_source, run.dividends_path, "incremental", today)
    return refresh(spark, run, today)


def run_range(spark, run, quotes_source, start, end):
    """Load the days ``start`` to ``end`` again, as a late correction, and bring the models up from ``start`` on."""
    load_quotes(quotes_source, run.quotes_path, "range", end, start, end, run.granularity)
    return refresh(spark, run, start)
