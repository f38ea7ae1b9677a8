"""Window column builders for one ordered series per key.

Each takes a ``SeriesWindow`` and knows nothing about how the series is laid out over tasks.
Windows count rows (sessions), not calendar days; short leading windows are kept.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapework.functions.scalar import change, ln, ratio


class SeriesWindow:
    """Window specifications over a whole series held by one task."""

    def __init__(self, partition, order):
        self.ordered = Window.partitionBy(*partition).orderBy(*order)
        self.so_far = self.ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def last_rows(self, n):
        """The current row and the n − 1 before it."""
        return self.ordered.rowsBetween(-(n - 1), Window.currentRow)

    def first(self, name):
        return F.first(name).over(self.so_far)

    def running_max(self, name):
        return F.max(name).over(self.so_far)


def previous(name, w):
    return F.lag(name, 1).over(w.ordered)


def simple_return(price, before):
    """p / previous p − 1; NULL on the first row."""
    return change(F.col(price), F.col(before))


def log_return(price, before):
    """ln(p / previous p); NULL on the first row."""
    return ln(ratio(F.col(price), F.col(before)))


def cumulative_return(price, first):
    """p / first p − 1; 0 on the first row."""
    return change(F.col(price), F.col(first))


def drawdown(price, peak):
    """p / peak − 1, 0 at a new high."""
    return change(F.col(price), F.col(peak))


def window_fill(n, position):
    """Rows actually inside the n-row window; below n the window is partial."""
    return F.least(F.col(position), F.lit(n)).cast("long")


# Values are split at this step: totals of its multiples are exact while they stay below 2**43. What is left of a value is
# less than a step and taken in multiples of the second one, whose totals are exact while they stay below 8.
TOTAL_STEP, REST_STEP = 2.0**-10, 2.0**-50


def rolling(df, w, position, means=None, deviations=None):
    """Averages and sample standard deviations over the last n rows, NULL values skipped.

    ``means`` and ``deviations`` map a column to ``{result name: n}``. Averages are the difference of two running
    totals n rows apart, so their work per row does not depend on n. Values are split into a multiple of
    ``TOTAL_STEP`` and a small rest, both with exact totals, so that large values early in a series cost the later
    windows no digits, and any cut of a series that leaves a window its rows gives the same bits (while totals stay below
    2**43 and those of rests below 8, as they do for 16,000 rows at least); values that are not finite stay out of the
    totals, and windows that hold one give NaN. Deviations are taken over the row frame itself: no total that forgets by
    subtraction could be trusted there, and n is a constant.
    """
    means, deviations = means or {}, deviations or {}
    df = df.withColumns({
        result: F.stddev_samp(name).over(w.last_rows(n)) for name, wanted in deviations.items() for result, n in wanted.items()})
    totals, lengths = {}, {}
    for name, wanted in means.items():
        value = F.col(name)
        finite = F.when(F.abs(value) < F.lit(float("inf")), value)
        step = F.rint(finite / TOTAL_STEP) * TOTAL_STEP
        summed = {"cnt": F.count(value), "whole": F.sum(step), "rest": F.sum(F.rint((finite - step) / REST_STEP) * REST_STEP)}
        for kind, total in summed.items():
            totals[f"_{kind}_{name}"] = F.coalesce(total.over(w.so_far), F.lit(0))
        not_finite = value.isNotNull() & finite.isNull()
        totals[f"_bad_{name}"] = F.max(F.when(not_finite, F.col(position))).over(w.so_far)
        lengths |= {f"_{kind}_{name}_{n}": (f"_{kind}_{name}", n) for kind in summed for n in wanted.values()}
    df = df.withColumns(totals)
    windows = {window: F.col(total) - F.lag(total, n, 0).over(w.ordered) for window, (total, n) in lengths.items()}
    df = df.withColumns(windows)
    results = {}
    for name, wanted in means.items():
        for result, n in wanted.items():
            whole, rest, count = (f"_{kind}_{name}_{n}" for kind in ("whole", "rest", "cnt"))
            results[result] = (f"CASE WHEN _bad_{name} > {position} - {n} THEN double('NaN') "
                               f"ELSE try_divide({whole} + {rest}, {count}) END")
    kept = [c for c in df.columns if c not in totals and c not in windows]
    return df.selectExpr(*kept, *[f"{value} AS {result}" for result, value in results.items()])
