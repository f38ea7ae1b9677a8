"""Refresh of the marts from a day on: rows are written aside, checked, and shown to readers in one step."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tapework.operators import dimensions, facts, indicators, quality, resume, staging
from tapework.operators.sets import multiset_difference
from tapework.schemas import FACT_DIVIDENDS, GRANULARITY, QUOTES
from tapework.session import stage_table
from tapework.sinks.layers import create_layer, create_view, register
from tapework.sinks.versions import FOLD_AFTER, YEAR, Manifest, Part, Store, Versioned, overlapping
from tapework.sources.generated import calendar_days
from tapework.sources.raw import read_companies, read_raw_dividends, read_raw_quotes, with_partition_bounds

QUOTE_FACT, DIVIDEND_FACT = "fato_cotacoes_diarias", "fato_dividendos"
DAILY, YIELDS, SUMMARY = "mart_indicadores_diarios", "mart_dividend_yield", "mart_indicadores_resumo"
COMPANY, CALENDAR, KEYS, STATE, YEARS = "dim_empresa", "dim_tempo", "chaves_empresa", "estado_pregoes", "resumo_anual"
#: Tables that readers see; the others carry a run to the next.
SHOWN = [COMPANY, CALENDAR, QUOTE_FACT, DAILY, YIELDS, SUMMARY]


def day_key(day):
    return int(f"{day:%Y%m%d}")


class Refresh:
    """One run over the raw layer of ``run``: all history, or the days from ``since`` on.

    Days before ``since`` must be loaded as the published tables have them; dividends are compared, so they may change on
    any day of the year of ``since`` and later. New companies bring their whole history. A company that is gone, or another
    calendar, makes the run a full one.
    """

    def __init__(self, spark, run, since=None):
        self.spark, self.run = spark, run
        self.store = Store(spark, f"{run.root}/marts", run.layers[1])
        self.old, self.lot = self.store.manifest(), uuid.uuid4().hex[:12]
        self.new = Manifest(self.old.version, dict(self.old.tables), dict(self.old.notes))
        companies = read_companies(spark, run.companies_csv)
        self.raw = read_raw_quotes(spark, run.quotes_path, run.granularity)
        self.raw_dividends = read_raw_dividends(spark, run.dividends_path)
        calendar = [str(run.calendar_start), str(run.calendar_end)]
        self.full = since is None or not self.old.tables or self.old.notes.get("calendar") != calendar or self._lost(companies)
        self.since = run.calendar_start if self.full else since
        self.from_key = 0 if self.full else day_key(since)
        self.new.notes["calendar"] = calendar
        if self.full:
            self.new.tables = {KEYS: self.old.tables[KEYS]} if KEYS in self.old.tables else {}
        self._dimensions(companies)

    def _lost(self, companies):
        return not self.store.read(COMPANY, self.old).join(companies, "ticker", "left_anti").isEmpty()

    def _put(self, name, rows, **options):
        """Write a table as a whole."""
        self.new.tables[name] = self.store.write_aside(rows, name, self.lot, self.old.tables.get(name), **options)

    def _dimensions(self, companies):
        known = self.store.read(KEYS, self.old) if KEYS in self.old.tables else None
        self._put(KEYS, dimensions.company_keys(companies, known), day=None)
        keys = self.store.read(KEYS, self.new)
        self._put(COMPANY, dimensions.keyed_companies(companies, keys), day=None)
        days = calendar_days(self.spark, self.run.calendar_start, self.run.calendar_end)
        self._put(CALENDAR, dimensions.dim_calendar(days), day=None)
        self.company, self.calendar = self.store.read(COMPANY, self.new), self.store.read(CALENDAR, self.new)
        before = self.store.read(COMPANY, self.old) if not self.full else None
        fresh = None if before is None else self.company.join(before, "ticker", "left_anti").select("ticker", "empresa_id")
        self.fresh = None if fresh is None or fresh.isEmpty() else fresh

    # --- tables by year ----------------------------------------------------------------------------

    def _append(self, name, rows, since, key=None):
        """Table ``name`` with its rows before day key ``since`` and the new ``rows``. Folders that end before stay as they
        are; what others hold of earlier days moves along, and a year of too many folders becomes one."""
        table = None if self.full else self.old.tables.get(name)
        if table is None:
            self._put(name, rows, key=key)
            return
        moved = overlapping(table, since)
        by_year = {}
        for part in table.parts:
            by_year.setdefault(part.year, []).append(part)
        moved += [p for parts in by_year.values() if len(parts) >= FOLD_AFTER for p in parts if p not in moved]
        if moved:
            carried = self.store.read(name, self.old, moved).where(F.col("tempo_id") < since)
            rows = rows.unionByName(carried.select(rows.columns))
        written = self.store.write_aside(rows, name, self.lot, table, key=table.key)
        self.new.tables[name] = Versioned(written.schema, table.key, table.count, [p for p in table.parts if p not in moved] + written.parts)

    def _touched(self, name):
        return sorted({p.year for p in self.new.tables[name].parts if p.lot == self.lot})

    def quotes(self):
        recent = self.raw if self.full else with_partition_bounds(self.raw, self.since, self.run.calendar_end)
        if self.fresh is not None:
            earlier = with_partition_bounds(self.raw, self.run.calendar_start, self.since - dt.timedelta(days=1))
            recent = recent.unionByName(earlier.join(self.fresh.select("ticker"), "ticker", "left_semi").select(recent.columns))
        self.staged = staging.stg_quotes(recent)
        self.sessions = stage_table(facts.fact_quotes(self.staged, self.company, self.calendar), "sessions")
        self._append(QUOTE_FACT, self.sessions, self.from_key, key="empresa_id")

    def state_before(self):
        """State of the companies before the first new day: the newest snapshot that is older, brought up to that day."""
        if self.full:
            return self.spark.createDataFrame([], "empresa_id long, tempo_id int, fechamento_ajustado double, volume long, primeiro double, pico double")
        older = [p for p in self.old.tables[STATE].parts if p.last < self.from_key]
        newest = max(older, key=lambda p: p.last, default=None)
        state = self.store.read(STATE, self.old, [newest]) if newest else None
        upto = newest.last if newest else 0
        between = [p for p in self.old.tables[QUOTE_FACT].parts if p.last > upto and p.first < self.from_key]
        if not between and state is not None:
            return state
        fact = self.store.read(QUOTE_FACT, self.old, between).where((F.col("tempo_id") > upto) & (F.col("tempo_id") < self.from_key))
        return stage_table(resume.state_after(fact, state), "state")

    def indicators(self):
        state = self.state_before()
        if self.fresh is not None:
            # companies of this run bring all their sessions, so they start anew
            state = state.join(self.fresh, "empresa_id", "left_anti")
        self._append(DAILY, resume.continued_indicators(state, self.sessions, self.calendar), self.from_key, key="empresa_id")
        after = resume.state_after(self.sessions, None if self.full else state)
        last = self.sessions.agg(F.max("tempo_id")).first()[0]
        kept = [] if self.full else [p for p in self.old.tables[STATE].parts if p.last < self.from_key]
        if last is not None and self.fresh is None:
            written = self.store.write_aside(after, STATE, self.lot, day=None)
            part = Part(self.lot, 0, sum(p.rows for p in written.parts), None, last, {})
            # the newest snapshot of each year
            newest = {p.last // 10_000: p for p in sorted([*kept, part], key=lambda p: p.last)}
            self.new.tables[STATE] = Versioned(written.schema, parts=list(newest.values()))
        elif last is not None:
            # snapshots do not know the new companies' earlier sessions: the next run starts from the fact
            schema = self.old.tables[STATE].schema
            self.new.tables[STATE] = Versioned(schema)
        elif STATE not in self.new.tables:
            self.new.tables[STATE] = self.store.write_aside(after, STATE, self.lot, day=None)

    def yields(self):
        first = 0 if self.full else self.since.year
        raw = self.raw_dividends.where(F.col("ano") >= first)
        self.staged_dividends = staging.stg_dividends(raw)
        events = stage_table(facts.fact_dividends(self.staged_dividends, self.company, self.calendar), "events")
        since = self.from_key
        if not self.full:
            before = self.store.read(DIVIDEND_FACT, self.old).where(F.col(YEAR) >= first).select(FACT_DIVIDENDS.names)
            own = events if self.fresh is None else events.join(self.fresh, "empresa_id", "left_anti").select(events.columns)
            changed = multiset_difference(before, own).agg(F.min("tempo_id")).first()[0]
            since = min(since, changed or since)
            if self.fresh is not None:
                earlier = facts.fact_dividends(staging.stg_dividends(self.raw_dividends.where(F.col("ano") < first)), self.fresh, self.calendar)
                events = stage_table(events.unionByName(earlier), "events")
        fresh_events = F.col("tempo_id") >= since
        rows = events.where(fresh_events) if self.fresh is None else events.join(
            self.fresh.select("empresa_id", F.lit(True).alias("_fresh")), "empresa_id", "left").where(fresh_events | F.col("_fresh")).select(events.columns)
        self._append(DIVIDEND_FACT, rows, since)
        quotes = self.sessions
        if since < self.from_key:
            own = self.store.read(QUOTE_FACT, self.new).where((F.col(YEAR) >= since // 10_000) & (F.col("tempo_id") >= since)).select(quotes.columns)
            quotes = own if self.fresh is None else own.unionByName(self.sessions.where(F.col("tempo_id") < since))
        paid = self.store.read(DIVIDEND_FACT, self.new)
        if not self.full and self.fresh is None:
            paid = paid.where(F.col(YEAR) >= since // 10_000 - 1)
        result = indicators.dividend_yield(quotes, paid.select(FACT_DIVIDENDS.names), self.calendar)
        self._append(YIELDS, result, since, key="empresa_id")

    def summary(self):
        years = self._touched(DAILY)
        daily = self.store.read(DAILY, self.new)
        parts = [] if self.full else [p for p in self.old.tables[YEARS].parts if p.year not in years]
        written = self.store.write_aside(resume.yearly_summary(daily.where(F.col(YEAR).isin(years)) if years else daily), YEARS, self.lot)
        self.new.tables[YEARS] = Versioned(written.schema, parts=parts + written.parts)
        self._put(SUMMARY, resume.merged_summary(self.store.read(YEARS, self.new), self.company), day=None)

    # --- checks and publication --------------------------------------------------------------------

    def checked(self):
        """The check report over what this run has written and all that it stands on: rows of the years it touched."""
        def own(name):
            rows, years = self.store.read(name, self.new), self._touched(name)
            return rows.where(F.col(YEAR).isin(years)) if YEAR in rows.columns and years else rows

        tables = {"stg_cotacoes": self.staged, "stg_dividendos": self.staged_dividends, COMPANY: self.company, CALENDAR: self.calendar,
                  QUOTE_FACT: own(QUOTE_FACT), DIVIDEND_FACT: own(DIVIDEND_FACT), DAILY: own(DAILY),
                  SUMMARY: self.store.read(SUMMARY, self.new), YIELDS: own(YIELDS)}
        report = stage_table(quality.run_checks(tables, self.run.tickers, {DAILY: self.store.read(DAILY, self.new)}), "checks")
        # the report holds one row per declared check
        failed = [r.teste for r in report.where(~F.col("aprovado")).collect()]
        if failed:
            raise RuntimeError(f"failed checks: {', '.join(sorted(failed))}")
        return report


def refresh(spark, run, since=None):
    """Bring the marts of ``run`` up to its raw layer, from day ``since`` on or in full, and return the check report.

    Readers see the tables of the last run until all checks have passed; then one manifest shows the new ones. A failed or
    killed run changes nothing they see.
    """
    staging_layer, marts = run.layers
    for layer in (run.raw_layer, *run.layers):
        create_layer(spark, layer, run.root)
    job = Refresh(spark, run, since)
    job.quotes()
    job.indicators()
    job.yields()
    job.summary()
    report = job.checked()
    job.store.publish(job.new)
    job.store.show(SHOWN, job.new)
    folders = GRANULARITY[run.granularity]
    register(job.raw.select(*QUOTES.names, *folders), run.raw_layer, "cotacoes", run.quotes_path, folders)
    register(job.raw_dividends, run.raw_layer, "dividendos", run.dividends_path, GRANULARITY["year"])
    names = {"raw": run.raw_layer, "staging": staging_layer, "marts": marts}
    for layer, name in ((staging_layer, "stg_cotacoes"), (staging_layer, "stg_dividendos"), (marts, "fato_dividendos")):
        create_view(spark, layer, name, names)
    return report
