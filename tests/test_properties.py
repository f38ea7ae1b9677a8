"""Laws that hold for any series, on random small inputs."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapework import cli
from tapework.operators import indicators, layout
from tapework.plans import reports
from tapework.schemas import QUOTES
from tapework.sources.raw import read_raw_quotes

BASE = "empresa_id long, tempo_id int, data date, fechamento_ajustado double, volume long"
START = dt.date(2020, 1, 1)
series = st.lists(
    st.tuples(st.integers(1, 3), st.integers(0, 400), st.integers(1, 10_000)), min_size=1, max_size=60,
    unique_by=lambda r: r[:2])
few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    return spark.createDataFrame(
        [(c, i, START + dt.timedelta(d), p / 100, 1) for i, (c, d, p) in enumerate(rows)], BASE)


def run(df, max_rows=layout.MAX_ROWS_PER_KEY):
    return layout.over_series(df, indicators.indicator_columns, key="empresa_id", date="data", halo=253,
                              carry=("fechamento_ajustado",), max_rows=max_rows)


@few
@given(rows=series, max_rows=st.sampled_from([layout.MAX_ROWS_PER_KEY, 5]))
def test_indicator_laws(spark, rows, max_rows):
    got = run(frame(spark, rows), max_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.drawdown <= 0 and r.pico_historico >= r.fechamento_ajustado
        assert r.volatilidade_30d is None or r.volatilidade_30d >= 0
        assert 1 <= r.pregoes_janela_7d <= 7 and r.pregoes_janela_7d <= r.pregoes_janela_200d


@few
@given(rows=series, seed=st.randoms())
def test_row_order_does_not_matter(spark, rows, seed):
    shuffled = list(rows)
    seed.shuffle(shuffled)
    picked = ["empresa_id", "data", "retorno_acumulado", "pico_historico", "pregoes_janela_30d"]
    a, b = (sorted(tuple(r) for r in run(frame(spark, x)).select(picked).collect()) for x in (rows, shuffled))
    assert a == b


@few
@given(rows=series, first=st.integers(0, 400), length=st.integers(0, 400))
def test_base_100_follows_the_return(spark, rows, first, length):
    company = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "empresa_id long, ticker string")
    start = START + dt.timedelta(first)
    got = reports.period_returns(frame(spark, rows), company, start, start + dt.timedelta(length)).collect()
    assert len(got) == sum(first <= d <= first + length for _, d, _ in rows)
    for r in got:
        assert r.base_100 == pytest.approx(100 * (1 + r.retorno_janela))


def test_load_from_the_command_line(spark, tmp_path):
    day = dt.date(2024, 2, 28)
    rows = [(day + dt.timedelta(i), "A", 1.0, 1.0, 1.0, 1.0, 1.0, None) for i in range(5)]
    source, target = str(tmp_path / "landed"), str(tmp_path / "raw")
    spark.createDataFrame(rows, QUOTES).write.parquet(source)
    common = ["cotacoes", "--fonte", source, "--destino", target]
    assert cli.main([*common, "--modo", "diario", "--hoje", "2024-02-29"]) == 0
    assert read_raw_quotes(spark, target).count() == 1
    assert cli.main([*common, "--modo", "range", "--inicio", "2024-02-28", "--fim", "2024-03-02"]) == 0
    assert read_raw_quotes(spark, target).where(F.col("volume").isNull()).count() == 4
    assert cli.main([*common, "--modo", "range", "--inicio", "2024-03-02", "--fim", "2024-02-28"]) == 1
    with pytest.raises(SystemExit):
        cli.main([*common, "--modo", "range", "--inicio", "02/03/2024"])
