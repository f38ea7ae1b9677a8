"""Relations that come from parameters: calendar days and literal mappings."""

from pyspark.sql import functions as F


def calendar_days(spark, start, end):
    """One row per day from ``start`` to ``end``, both included."""
    days = (end - start).days + 1
    if days < 1:
        raise ValueError(f"calendar {start}..{end} has no day")
    bounds = spark.range(0, 1, 1, 1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return days_between(bounds, "first", "last")


def days_between(bounds, first, last):
    """Explode a one-row relation of two dates into its days, ends included."""
    step = F.expr("interval 1 day")
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last), step)).alias("data"))


def literal_mapping(spark, pairs, key="ticker", value="setor"):
    """Small key → value relation written out in code."""
    return spark.createDataFrame(list(pairs.items()), f"{key} string, {value} string")
