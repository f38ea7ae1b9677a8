"""Idempotent partition writes of the raw layer."""

from pyspark.sql import functions as F

from tapework.functions.scalar import partition_keys
from tapework.schemas import DIVIDENDS, GRANULARITY, QUOTES
from tapework.session import stage_table
from tapework.sources.raw import read_raw_quotes


def _write(df, path, date, columns):
    """Replace the partitions ``df`` touches and leave the others; returns how many it touched.

    The rebalance hint lets AQE merge small partitions into a task and split a large one by size.
    """
    keys = partition_keys(F.col(date))
    touched = df.select([keys[c].alias(c) for c in columns]).distinct().count()
    if not touched:
        return 0
    keyed = df.withColumns({c: keys[c] for c in columns}).hint("rebalance", *[F.col(c) for c in columns])
    (
        keyed.write.partitionBy(*columns).option("partitionOverwriteMode", "dynamic")
        .mode("overwrite").option("compression", "snappy").parquet(path)
    )
    return touched


def _with_other_days(df, path, granularity):
    """``df`` and the stored rows of its partitions whose days it does not hold, as a written table.

    The unit that a load replaces is the day, whatever the layout; a month or year partition is
    replaced as a whole and so has to carry its other days over.
    """
    columns = GRANULARITY[granularity]
    days = df.select("data").distinct()
    first, last = days.agg(F.min("data"), F.max("data")).first()
    if first is None:
        return df
    keys = partition_keys(F.col("data"))
    partitions = days.select([keys[c].alias(c) for c in columns]).distinct()
    stored = read_raw_quotes(df.sparkSession, path, granularity).where(F.col("ano").between(first.year, last.year))
    others = stored.join(partitions, columns, "left_semi").join(days, "data", "left_anti").select(QUOTES.names)
    # Spark does not overwrite a path that the same plan reads
    return stage_table(df.unionByName(others), "partitions")


def write_quotes(df, path, granularity="day"):
    """Replace the days of ``df`` and keep all others. One partition per day by default; coarser ones
    avoid many small files on long histories."""
    if df.columns != QUOTES.names:
        raise ValueError(f"unexpected columns {df.columns}, expected {QUOTES.names}")
    if granularity != "day":
        df = _with_other_days(df, path, granularity)
    return _write(df, path, "data", GRANULARITY[granularity])


def write_dividends(df, path, years=None):
    """One partition per ex-date year, replaced as a whole; ``years`` limits the write to those."""
    if df.columns != DIVIDENDS.names:
        raise ValueError(f"unexpected columns {df.columns}, expected {DIVIDENDS.names}")
    if years is not None:
        df = df.where(F.year("data_ex").isin(sorted(years)))
    return _write(df, path, "data_ex", GRANULARITY["year"])
