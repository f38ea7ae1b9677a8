"""Load jobs from the command line: ``python -m tapework.cli cotacoes --modo diario …``.

The source is landed long-form Parquet; the session comes from spark-submit.
"""

import argparse
import datetime as dt
import logging
import sys

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from tapework.functions.scalar import parse_day
from tapework.operators.staging import canonical
from tapework.plans.loads import HISTORY_YEARS, DailyRun, ingest_vendor_bars, load_dividends, load_quotes, run_daily
from tapework.schemas import DIVIDENDS, GRANULARITY, QUOTES

log = logging.getLogger("tapework")


def years(text):
    return None if text == "tudo" else int(text)


def parser():
    top = argparse.ArgumentParser(prog="python -m tapework.cli")
    commands = top.add_subparsers(dest="tabela", required=True)
    quotes = commands.add_parser("cotacoes")
    quotes.add_argument("--modo", required=True, choices=["inicial", "diario", "range"])
    quotes.add_argument("--inicio", type=parse_day)
    quotes.add_argument("--fim", type=parse_day)
    quotes.add_argument("--granularidade", default="day", choices=list(GRANULARITY))
    dividends = commands.add_parser("dividendos")
    dividends.add_argument("--modo", required=True, choices=["inicial", "incremental"])
    vendor = commands.add_parser("fornecedor", help="wide vendor frame to the raw layer, with its coverage")
    daily = commands.add_parser("dia", help="load one day, rebuild staging and marts, run the checks")
    for command in (quotes, dividends, vendor):
        command.add_argument("--fonte", required=True)
        command.add_argument("--destino", required=True)
    for command in (vendor, daily):
        command.add_argument("--tickers", required=True, help="comma-separated")
        command.add_argument("--granularidade", default="day", choices=list(GRANULARITY))
    for command in (quotes, vendor):
        command.add_argument("--anos", type=years, default=HISTORY_YEARS, help="years of history of inicial, or tudo")
    vendor.add_argument("--modo", required=True, choices=["inicial", "diario", "range"])
    vendor.add_argument("--inicio", type=parse_day)
    vendor.add_argument("--fim", type=parse_day)
    daily.add_argument("--raiz", required=True)
    daily.add_argument("--cotacoes", required=True)
    daily.add_argument("--dividendos", required=True)
    daily.add_argument("--empresas", required=True)
    daily.add_argument("--calendario", required=True, nargs=2, type=parse_day)
    for command in (quotes, dividends, vendor, daily):
        command.add_argument("--hoje", type=parse_day, default=None)
    return top


def run(spark, args, today):
    """The command's job; returns the partitions written, or the checks passed by a daily run."""
    if args.tabela == "dia":
        daily = DailyRun(args.raiz, args.empresas, args.tickers.split(","), *args.calendario, args.granularidade)
        quotes, dividends = spark.read.parquet(args.cotacoes), spark.read.parquet(args.dividendos)
        return run_daily(spark, daily, canonical(quotes, QUOTES), canonical(dividends, DIVIDENDS), today).count()
    source = spark.read.parquet(args.fonte)
    if args.tabela == "fornecedor":
        written, coverage = ingest_vendor_bars(source, args.tickers.split(","), args.destino, args.modo, today, args.inicio,
                                               args.fim, args.granularidade, args.anos)
        log.info("coverage: %s", coverage.first().asDict())
        return written
    if args.tabela == "cotacoes":
        return load_quotes(canonical(source, QUOTES), args.destino, args.modo, today, args.inicio, args.fim,
                           args.granularidade, args.anos)
    return load_dividends(canonical(source, DIVIDENDS), args.destino, args.modo, today)


def main(argv=None):
    args = parser().parse_args(argv)
    today = args.hoje or dt.date.today()
    spark = SparkSession.builder.getOrCreate()
    try:
        written = run(spark, args, today)
    except (ValueError, RuntimeError, PySparkException) as exc:
        log.error("load failed: %s", exc)
        return 1
    log.info("%s: %d partitions written or checks passed", args.tabela, written)
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())
