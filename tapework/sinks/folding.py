"""Day folders of closed months folded into few files, clustered by company and date."""

import datetime as dt

from pyspark.sql import functions as F

from tapework.functions.scalar import partition_keys
from tapework.schemas import GRANULARITY, RAW_QUOTES
from tapework.session import stage_table, unstage
from tapework.sources.raw import read_raw_quotes

#: Rows of a folded file; small enough that a file holds few companies, large enough that a month is few files.
ROWS_PER_FILE = 5_000_000
DAY = GRANULARITY["day"]
MONTH = GRANULARITY["month"]


def _last_closed(until):
    """Year and month, as one number, of the last month that is over when ``until`` is."""
    after = until + dt.timedelta(days=1)
    last = after.replace(day=1) - dt.timedelta(days=1)
    return last.year * 100 + last.month


def _drop_days(spark, daily, days):
    """Delete the given day folders; a folder that is gone already is no error."""
    for r in days:
        folder = "/".join(f"{c}={r[c]}" for c in DAY)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{daily}/{folder}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_folded(spark, daily, folded):
    """Raw quotes of both folders. A day that has a folder of its own counts from there: it is a correction, or its
    folding was not finished. Only folder names of ``daily`` are read to find such days."""
    recent = read_raw_quotes(spark, daily)
    closed = read_raw_quotes(spark, folded, "month").join(recent.select(DAY).distinct(), DAY, "left_anti")
    return closed.select(RAW_QUOTES.names).unionByName(recent)


def fold_months(spark, daily, folded, until, rows_per_file=ROWS_PER_FILE):
    """Move the days of ``daily`` whose month is over on ``until`` to month folders of ``folded``; how many days moved.

    A month that was folded before keeps its other days. Files are ranges of ticker and date, so a reader of one
    ticker skips the others by their statistics. Days are deleted from ``daily`` only after they were written;
    ``read_folded`` gives the same rows before, between and after, and a run that was killed is repeated. No load may
    write to closed months meanwhile. Rows of a month are spread over as many tasks as their size asks for.
    """
    closed = read_raw_quotes(spark, daily).where(F.col("ano") * 100 + F.col("mes") <= _last_closed(until))
    # folder names, at most one row per calendar day
    day = partition_keys(F.make_date("ano", "mes", "dia"))
    days = closed.select([day[c].alias(c) for c in DAY]).distinct().collect()
    if not days:
        return 0
    months = closed.select(MONTH).distinct()
    others = read_folded(spark, daily, folded).join(months, MONTH, "left_semi")
    # Spark does not overwrite a path that the same plan reads, and ranges are sampled first
    rows = stage_table(others, "folding")
    month = partition_keys(F.col("data"))
    keys = [*MONTH, "ticker", "data"]
    (
        rows.drop("dia").withColumns({c: month[c] for c in MONTH}).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .write.partitionBy(*MONTH).option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file)
        .mode("overwrite").parquet(folded)
    )
    _drop_days(spark, daily, days)
    unstage(rows)
    return len(days)
