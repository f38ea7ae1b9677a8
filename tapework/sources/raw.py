"""Raw layer and company seed readers."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapework.schemas import (
    COMPANIES, GRANULARITY, QUOTE_PARTITIONS, QUOTES, RAW_DIVIDENDS, RAW_QUOTES, empty,
)


def read_partitioned(spark, path, schema):
    """Hive-partitioned Parquet with a fixed schema; a missing path is an empty table."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def read_raw_quotes(spark, path, granularity="day"):
    """Quotes with ``ano``, ``mes`` and ``dia``, of which those not in the path come from the date."""
    in_path = GRANULARITY[granularity]
    stored = T.StructType(QUOTES.fields + [f for f in QUOTE_PARTITIONS.fields if f.name in in_path])
    from_date = {"ano": F.year("data"), "mes": F.month("data"), "dia": F.dayofmonth("data")}
    raw = read_partitioned(spark, path, stored)
    return raw.withColumns(
        {name: part for name, part in from_date.items() if name not in in_path}).select(RAW_QUOTES.names)


def read_raw_dividends(spark, path):
    return read_partitioned(spark, path, RAW_DIVIDENDS)


def read_companies(spark, path):
    return spark.read.schema(COMPANIES).csv(path, header=True, encoding="UTF-8", quote='"', escape='"')


def with_partition_bounds(raw, start, end, date="data"):
    """Rows of ``start..end``. Bounds on the partition columns let the scan skip partitions, which a
    filter on the date alone would not; each bound works for the layouts that store its columns."""
    bounds = F.col("ano").between(start.year, end.year) & F.col(date).between(start, end)
    if "mes" in raw.columns:
        month = F.col("ano") * 100 + F.col("mes")
        bounds &= month.between(start.year * 100 + start.month, end.year * 100 + end.month)
    if "dia" in raw.columns:
        day = (F.col("ano") * 100 + F.col("mes")) * 100 + F.col("dia")
        bounds &= day.between(int(f"{start:%Y%m%d}"), int(f"{end:%Y%m%d}"))
    return raw.where(bounds)
