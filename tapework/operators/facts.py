"""Facts keyed by surrogates, and the rows that fail to find their dimensions.

Joins carry no broadcast hint: Catalyst and AQE broadcast a dimension while its size is below the
session's threshold and otherwise sort-merge with skewed keys split.
"""

from pyspark.sql import functions as F

from tapework.schemas import FACT_DIVIDENDS, FACT_QUOTES


def with_company(df, company, *columns):
    """Inner join by natural key; unknown tickers drop out."""
    return df.join(company.select("ticker", *columns), "ticker")


def with_company_id(df, company, *columns):
    """Inner join by surrogate key."""
    return df.join(company.select("empresa_id", *columns), "empresa_id")


def with_calendar_key(df, calendar, date="data"):
    """Inner join by date; dates outside the calendar drop out."""
    keys = calendar.select("tempo_id", F.col("data").alias(date))
    return df.join(keys, date)


def with_date(fact, calendar, name="data"):
    """Resolve the surrogate day back to a date; ``name`` is the role the calendar plays."""
    return fact.join(calendar.select("tempo_id", F.col("data").alias(name)), "tempo_id")


def fact_quotes(quotes, company, calendar):
    return with_calendar_key(with_company(quotes, company, "empresa_id"), calendar).select(
        FACT_QUOTES.names)


def fact_dividends(dividends, company, calendar):
    joined = with_calendar_key(with_company(dividends, company, "empresa_id"), calendar, "data_ex")
    return joined.select(FACT_DIVIDENDS.names)


def rejected_rows(df, company, calendar, date="data"):
    """Staged rows that the fact's inner joins lose, one row each with the reason: ``ticker``, ``data``
    or both; counted by the caller."""
    known = company.select("ticker", F.lit(True).alias("_known")).distinct()
    dated = calendar.select(F.col("data").alias(date), F.lit(True).alias("_dated")).distinct()
    marked = df.join(known, "ticker", "left").join(dated, date, "left")
    reason = F.concat_ws(" e ", F.when(F.col("_known").isNull(), "ticker"), F.when(F.col("_dated").isNull(), "data"))
    return marked.where(F.col("_known").isNull() | F.col("_dated").isNull()).select("ticker", date, reason.alias("motivo"))
