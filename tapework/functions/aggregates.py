"""Aggregate column builders shared by marts and reports."""

from pyspark.sql import functions as F

# Fixed value: trading sessions per year used to annualise a daily volatility.
SESSIONS_PER_YEAR = 252


def arg_max(x, by):
    """Value of ``x`` at the largest ``by`` among rows where ``x`` is not NULL."""
    return F.max_by(x, F.when(x.isNotNull(), by))


def arg_min(x, by):
    """Value of ``x`` at the smallest ``by`` among rows where ``x`` is not NULL."""
    return F.min_by(x, F.when(x.isNotNull(), by))


def annualize(volatility, sessions=SESSIONS_PER_YEAR):
    return volatility * F.sqrt(F.lit(float(sessions)))


def sample_volatility(log_return, sessions=SESSIONS_PER_YEAR):
    """Annualised sample standard deviation; NULL below two values."""
    return annualize(F.stddev_samp(log_return), sessions)
