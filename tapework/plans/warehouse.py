"""The models in dependency order: staging → dimensions → facts → marts."""

from functools import cached_property

from pyspark.sql import functions as F

from tapework.operators import dimensions, facts, indicators, quality, staging
from tapework.operators.layout import MAX_ROWS_PER_KEY
from tapework.session import stage_table


class Warehouse:
    """Lazily composed models over one set of raw tables.

    Staging and the dividend fact are views. The quote fact is written once, because several plans
    read it; dimensions and marts are written where a caller reads them more than once. ``write``
    takes a DataFrame and a model name and returns the written table.
    """

    def __init__(self, quotes, dividends, companies, days, max_rows=MAX_ROWS_PER_KEY, write=stage_table, company=None):
        self.raw_quotes = quotes
        self.raw_dividends = dividends
        self.companies = companies
        self.days = days
        self.max_rows = max_rows
        self.write = write
        if company is not None:
            self.company = company

    def of_ticker(self, ticker):
        """The models of one ticker, with its key among all companies. Windows never cross companies,
        so the ticker can be picked below them."""
        own = F.col("ticker") == ticker
        return Warehouse(self.raw_quotes.where(own), self.raw_dividends.where(own), self.companies, self.days,
                         self.max_rows, self.write, self.company.where(own))

    @cached_property
    def stg_quotes(self):
        return staging.stg_quotes(self.raw_quotes)

    @cached_property
    def stg_dividends(self):
        return staging.stg_dividends(self.raw_dividends)

    @cached_property
    def company(self):
        return dimensions.dim_company(self.companies)

    @cached_property
    def calendar(self):
        return dimensions.dim_calendar(self.days)

    @cached_property
    def quotes_view(self):
        """The quote fact unwritten, for plans that read it once."""
        return facts.fact_quotes(self.stg_quotes, self.company, self.calendar)

    @cached_property
    def quotes(self):
        return self.write(self.quotes_view, "fato_cotacoes_diarias")

    @cached_property
    def dividends(self):
        return facts.fact_dividends(self.stg_dividends, self.company, self.calendar)

    @cached_property
    def daily(self):
        return indicators.daily_indicators(self.quotes, self.calendar, self.max_rows)

    @cached_property
    def daily_table(self):
        return self.write(self.daily, "mart_indicadores_diarios")

    @cached_property
    def summary(self):
        return indicators.indicator_summary(self.daily, self.company)

    @cached_property
    def yields(self):
        return indicators.dividend_yield(self.quotes, self.dividends, self.calendar, self.max_rows)

    @cached_property
    def yields_table(self):
        return self.write(self.yields, "mart_dividend_yield")

    def written(self):
        """All models by name; dimensions, quote fact and marts are written, each once."""
        self.company = self.write(self.company, "dim_empresa")
        self.calendar = self.write(self.calendar, "dim_tempo")
        summary = indicators.indicator_summary(self.daily_table, self.company)
        return {
            "stg_cotacoes": self.stg_quotes,
            "stg_dividendos": self.stg_dividends,
            "dim_empresa": self.company,
            "dim_tempo": self.calendar,
            "fato_cotacoes_diarias": self.quotes,
            "fato_dividendos": self.dividends,
            "mart_indicadores_diarios": self.daily_table,
            "mart_indicadores_resumo": self.write(summary, "mart_indicadores_resumo"),
            "mart_dividend_yield": self.yields_table,
        }

    def checks(self, tickers):
        return quality.run_checks(self.written(), tickers)
