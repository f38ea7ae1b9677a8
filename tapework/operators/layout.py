"""How per-key work is spread over tasks.

A daily series has one row per key and day, so one task per key is the cheap plan: one shuffle, one
sort. Keys that hold more rows than a task should take (intraday-like feeds, copied loads) are found
by a count first and cut into blocks; the rest keeps the cheap plan. Both give the same rows.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapework.functions.series import SeriesWindow
from tapework.session import stage_table

# Rows of one key that a single task may sort and scan.
MAX_ROWS_PER_KEY = 200_000
# Numbers left between two days for the slices of one day; rows without a date come last.
_DAY_STEP = 2**31
_NO_DAY = 2**31 - 1


class BlockWindow(SeriesWindow):
    """Window inside one block of a split series; values from earlier blocks arrive as columns."""

    def first(self, name):
        return F.col(f"_first_{name}")

    def running_max(self, name):
        return F.greatest(F.col(f"_peak_{name}"), F.max(name).over(self.so_far))


def hot_keys(df, key, max_rows):
    """Keys holding more than ``max_rows`` rows with their count; at most rows / max_rows keys."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > max_rows)


def split_hot(df, key, max_rows):
    """(rows of ordinary keys, rows of hot keys, hot keys with their count in ``_rows``); the last two
    are None when no key is hot."""
    hot = hot_keys(df, key, max_rows)
    if hot.isEmpty():
        return df, None, None
    hot = stage_table(hot, "hot-keys")
    match = df[key].eqNullSafe(hot[key])
    return df.join(hot, match, "left_anti"), df.join(hot, match, "left_semi"), hot


def over_series(df, build, *, key, date, halo, carry=(), max_rows=MAX_ROWS_PER_KEY):
    """Apply ``build(df, window)`` to every series of ``df``.

    ``halo`` is how many earlier rows a result row may look at; ``carry`` names the columns whose
    first value and running maximum over the whole series ``build`` asks the window for.
    """
    ordinary, hot, _ = split_hot(df, key, max_rows)
    whole = build(ordinary, SeriesWindow([key], [F.col(date).asc_nulls_last()]))
    if hot is None:
        return whole
    blocks = split_series(hot, key=key, date=date, halo=halo, carry=carry, block_rows=max_rows)
    order = [F.col(c) for c in ("_slice", "_row")]
    split = build(blocks, BlockWindow([key, "_block"], order)).where("_own").select(whole.columns)
    return whole.unionByName(split)


def split_series(df, *, key, date, halo, carry, block_rows):
    """Cut series into blocks that can be computed apart.

    Adds ``_block``; ``_own`` (false on the copies of the ``halo`` earlier rows that the next block
    needs); ``_slice`` and ``_row``, the order inside a series; and for each carry column the first
    value and the maximum over all earlier slices. A slice is a day, or a hash part of a day that
    holds more than ``block_rows`` rows: rows of one day have no order of their own, so a stored row
    number settles it.
    """
    numbered = stage_table(df.withColumn("_row", F.monotonically_increasing_id()), "series").withColumn(
        "_day", F.coalesce(F.unix_date(F.col(date)), F.lit(_NO_DAY)).cast("long"))
    # at most rows / block_rows of them
    full_days = (
        numbered.groupBy(F.col(key).alias("_key"), F.col("_day").alias("_full"))
        .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_rows)
        .select("_key", "_full", F.ceil(F.col("_n") / block_rows).alias("_parts"))
    )
    same_day = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_day") == F.col("_full"))
    part = F.pmod(F.xxhash64("_row"), F.coalesce(F.col("_parts"), F.lit(1)))
    sliced = (
        numbered.join(full_days, same_day, "left")
        .withColumn("_slice", F.col("_day") * _DAY_STEP + part)
        .drop("_key", "_full", "_parts", "_day")
    )

    per_slice = sliced.groupBy(key, "_slice").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.min_by(c, "_row").alias(f"_first_{c}") for c in carry],
        *[F.max(c).alias(f"_peak_{c}") for c in carry],
    )
    by_slice = Window.partitionBy(key).orderBy("_slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    so_far = by_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_position = Window.partitionBy(key).orderBy("_before")
    edges = (
        per_slice
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_block", F.floor(F.col("_before") / block_rows))
        .withColumn("_block", F.dense_rank().over(Window.partitionBy(key).orderBy("_block")))
        # last block that reaches back to the slice ending where this one starts
        .withColumn("_reach", F.max("_block").over(by_position.rangeBetween(0, max(halo - 1, 0))))
        .withColumn("_last", F.coalesce(F.lead("_reach").over(by_position), F.col("_block")))
        .withColumns({f"_first_{c}": F.first(f"_first_{c}").over(so_far) for c in carry})
        .withColumns({f"_peak_{c}": F.max(f"_peak_{c}").over(earlier) for c in carry})
        .drop("_n", "_before", "_reach")
        .withColumnsRenamed({key: "_key", "_slice": "_edge", "_block": "_home"})
    )
    match = sliced[key].eqNullSafe(edges["_key"]) & (sliced["_slice"] == edges["_edge"])
    return (
        sliced.join(edges, match)
        .withColumn("_block", F.explode(F.sequence("_home", "_last")))
        .withColumn("_own", F.col("_block") == F.col("_home"))
        .drop("_key", "_edge", "_home", "_last")
    )
