"""Scalar column builders: date keys, calendar parts, tickers, percent text, guarded arithmetic."""

import datetime as dt

from pyspark.sql import functions as F

from tapework.schemas import EXCHANGE_SUFFIX

# Portuguese month and weekday names (Sunday first).
MONTH_NAMES = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
WEEKDAY_NAMES = [
    "Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira",
    "Quinta-feira", "Sexta-feira", "Sábado",
]


def date_key(day):
    """Date → integer YYYYMMDD."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def weekday(day):
    """0 = Sunday … 6 = Saturday."""
    return (F.dayofweek(day) - 1).cast("long")


def month_name(day):
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), F.month(day))


def weekday_name(day):
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), F.dayofweek(day))


def is_weekend(day):
    return weekday(day).isin(0, 6)


def is_month_start(day):
    return F.dayofmonth(day) == 1


def is_month_end(day):
    return day == F.last_day(day)


def month_start(year, month):
    """Year and month columns → first day of the month."""
    return F.make_date(year, month, F.lit(1))


def ratio(x, y):
    """x / y, NULL when y is zero."""
    return F.try_divide(x, y)


def change(x, base):
    """x / base − 1."""
    return ratio(x, base) - F.lit(1.0)


def ln(x):
    """Natural logarithm, NULL for x ≤ 0."""
    return F.when(x > 0, F.log(x))


def percent(x, digits):
    return F.round(x * 100, digits)


def percent_text(x, digits=1):
    """0.071 → '7.1%'; NULL or NaN → dash."""
    absent = x.isNull() | F.isnan(x)
    return F.when(absent, F.lit("—")).otherwise(F.format_string(f"%.{digits}f%%", x * 100))


def with_suffix(ticker):
    return F.concat(ticker, F.lit(EXCHANGE_SUFFIX))


def without_suffix(ticker):
    return F.regexp_replace(ticker, EXCHANGE_SUFFIX.replace(".", r"\.") + "$", "")


def partition_keys(day):
    """Zero-padded hive partition values of a date."""
    return {
        "ano": F.date_format(day, "yyyy"),
        "mes": F.date_format(day, "MM"),
        "dia": F.date_format(day, "dd"),
    }


def period_start(newest, oldest, months):
    """Start of the last ``months`` months up to ``newest``, not before ``oldest``; None = all."""
    if months is None:
        return oldest
    return F.greatest(F.add_months(newest, -months), oldest)


def parse_day(text):
    """ISO date parameter; anything else is an error."""
    try:
        return dt.datetime.strptime(text, "%Y-%m-%d").date()
    except (TypeError, ValueError) as exc:
        raise ValueError(f"invalid date {text!r}, use YYYY-MM-DD") from exc
