"""Cleaning of raw quotes and dividends."""

from pyspark.sql import functions as F

from tapework.schemas import DIVIDENDS, PRICE_COLUMNS, QUOTES


def stg_quotes(raw):
    """Canonical columns; bars without adjusted close or with open/high/low missing or not above
    zero are dropped. Volume is not part of the test: NULL volume means unknown."""
    usable = F.col("fechamento_ajustado").isNotNull()
    for price in ("abertura", "maxima", "minima"):
        usable = usable & (F.col(price) > 0)
    return raw.where(usable).select(QUOTES.names)


def stg_dividends(raw):
    """Typed columns; missing and non-positive amounts are dropped."""
    typed = raw.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in DIVIDENDS.fields])
    return typed.where(F.col("valor_dividendo") > 0)


def drop_empty_bars(bars):
    """Drop rows whose price columns are all missing (NaN counts as missing)."""
    return bars.na.drop(how="all", subset=PRICE_COLUMNS)


def canonical(df, schema, renames=None):
    """Rename, then project and cast to the contract's columns in order."""
    renamed = df.withColumnsRenamed(renames or {})
    return renamed.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
