import datetime as dt
import glob
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tapework.operators import sets
from tapework.schemas import QUOTES, RAW_QUOTES
from tapework.sinks import folding
from tapework.sinks.partitioned import write_quotes

FIRST = dt.date(2024, 1, 2)
TICKERS = [f"T{i:02d}" for i in range(12)]


def bars(spark, first, days, volume=100):
    return spark.createDataFrame([(first + dt.timedelta(days=k), t, 10.0, 11.0, 9.0, 10.0, 10.0, volume) for k in range(days) for t in TICKERS], QUOTES)


@pytest.fixture
def layers(spark, tmp_path):
    daily, folded = str(tmp_path / "day"), str(tmp_path / "month")
    write_quotes(bars(spark, FIRST, 75), daily)  # to 2024-03-16
    return daily, folded


def rows(spark, layers):
    return folding.read_folded(spark, *layers)


def same(a, b):
    return sets.multiset_difference(a, b.select(a.columns)).isEmpty()


def folders(path):
    return sorted(str(Path(p).relative_to(path)) for p in glob.glob(f"{path}/ano=*/mes=*/dia=*"))


@pytest.mark.parametrize("until,last", [(dt.date(2024, 2, 29), 202402), (dt.date(2024, 2, 28), 202401), (dt.date(2024, 1, 1), 202312)])
def test_a_month_is_closed_on_its_last_day(until, last):
    assert folding._last_closed(until) == last


def test_folding_keeps_every_row_and_leaves_open_months(spark, layers):
    before = bars(spark, FIRST, 75)
    assert folding.fold_months(spark, *layers, dt.date(2024, 3, 10)) == 30 + 29
    got = rows(spark, layers)
    assert got.columns == RAW_QUOTES.names and same(before, got)
    assert len(folders(layers[0])) == 16 and all("mes=03" in f for f in folders(layers[0]))
    assert folding.fold_months(spark, *layers, dt.date(2024, 3, 10)) == 0


def test_a_correction_wins_before_and_after_it_is_folded(spark, layers):
    folding.fold_months(spark, *layers, dt.date(2024, 2, 29))
    doubled = bars(spark, dt.date(2024, 1, 30), 4, volume=200)
    write_quotes(doubled, layers[0])
    want = bars(spark, FIRST, 75).withColumn("volume", F.when(F.col("data").between("2024-01-30", "2024-02-02"), F.lit(200)).otherwise(100).cast("long"))
    assert same(want, rows(spark, layers))
    assert folding.fold_months(spark, *layers, dt.date(2024, 2, 29)) == 4
    assert same(want, rows(spark, layers)) and len(folders(layers[0])) == 16


def test_a_run_killed_between_write_and_delete_is_repeated(spark, layers, monkeypatch):
    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(folding, "_drop_days", killed)
        with pytest.raises(RuntimeError):
            folding.fold_months(spark, *layers, dt.date(2024, 3, 31))
    want = bars(spark, FIRST, 75)
    assert same(want, rows(spark, layers))
    assert folding.fold_months(spark, *layers, dt.date(2024, 3, 31)) == 75
    assert same(want, rows(spark, layers)) and folders(layers[0]) == []


def test_files_hold_few_tickers_and_filters_reach_them(spark, layers):
    folding.fold_months(spark, *layers, dt.date(2024, 2, 29), rows_per_file=60)
    files = glob.glob(f"{layers[1]}/ano=*/mes=*/*.parquet")
    holding = 0
    for f in files:
        group = pq.ParquetFile(f).metadata
        at = group.schema.to_arrow_schema().get_field_index("ticker")
        stats = [group.row_group(i).column(at).statistics for i in range(group.num_row_groups)]
        holding += any(s.min <= "T05" <= s.max for s in stats)
    assert len(files) >= 10 and 0 < holding <= len(files) // 3
    one = rows(spark, layers).where((F.col("ticker") == "T05") & (F.col("ano") == 2024) & (F.col("mes") == 1))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 30 and plan.count("EqualTo(ticker,T05)") == 2 and "(mes" in plan.split("PartitionFilters: [", 1)[1]


def test_nothing_to_fold(spark, tmp_path):
    paths = str(tmp_path / "a"), str(tmp_path / "b")
    assert folding.fold_months(spark, *paths, FIRST) == 0 and rows(spark, paths).isEmpty()
