"""Data checks. Each returns the violating rows; no rows means the check passes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapework.schemas import EXCHANGE_SUFFIX


def not_null(df, column):
    return df.where(F.col(column).isNull())


def unique_combination(df, columns):
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unique(df, column):
    """NULL keys are not compared."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def _not_accepted(column, values):
    return ~F.col(column).isin(list(values))


def accepted_values(df, column, values):
    """NULL passes. ``values`` is a list, or a relation that has them in a column of the same name."""
    if isinstance(values, DataFrame):
        return relationships(df, column, values, column)
    return df.where(_not_accepted(column, values))


def price_not_positive(df):
    """Warning: rows whose close or low is not above zero, of which returns and logarithms are NULL."""
    return df.where((F.col("fechamento") <= 0) | (F.col("minima") <= 0))


def relationships(child, column, parent, parent_column):
    """Child rows whose key has no parent; NULL keys are not compared."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def row_rules(table):
    """Violation conditions of a table by rule name; NULL never violates."""
    low, high, close = F.col("minima"), F.col("maxima"), F.col("fechamento")
    rules = {
        "fato_cotacoes_diarias": {
            "volume_nao_negativo": F.col("volume") < 0,
            "maxima_maior_igual_minima": high < low,
            "fechamento_dentro_do_range": (close < low) | (close > high),
        },
        "mart_indicadores_diarios": {
            "drawdown_nao_positivo": F.col("drawdown") > 0,
            "volatilidade_nao_negativa": (F.col("volatilidade_30d") < 0)
            | (F.col("volatilidade_90d") < 0) | (F.col("volatilidade_252d") < 0),
        },
        "mart_dividend_yield": {"yield_nao_negativo": F.col("dy_12m") < 0},
    }
    return rules.get(table, {})


def violates(df, table, rule):
    return df.where(row_rules(table)[rule])


def first_session_return(daily):
    """Companies whose first session carries a return, found by aggregation instead of ranking."""
    first = daily.groupBy("empresa_id").agg(
        F.min("data").alias("data"), F.min_by("tempo_id", "data").alias("tempo_id"),
        F.min_by("retorno_simples", "data").alias("retorno_simples"))
    return first.where(F.col("retorno_simples").isNotNull()).select(
        "empresa_id", "tempo_id", "retorno_simples")


def leftover_suffix(df):
    """Raw rows whose ticker still carries the exchange suffix."""
    return df.where(F.col("ticker").endswith(EXCHANGE_SUFFIX))


# Declared tests of every table.
NOT_NULL = {
    "stg_cotacoes": ["data", "ticker", "fechamento_ajustado"],
    "stg_dividendos": ["data_ex", "ticker", "valor_dividendo"],
    "fato_cotacoes_diarias": ["empresa_id", "tempo_id", "fechamento_ajustado"],
    "dim_empresa": ["empresa_id", "ticker", "nome", "setor"],
    "dim_tempo": ["tempo_id", "data"],
    "fato_dividendos": ["empresa_id", "tempo_id", "valor_dividendo"],
    "mart_indicadores_diarios": ["empresa_id", "tempo_id"],
    "mart_indicadores_resumo": ["empresa_id", "ticker", "max_drawdown"],
    "mart_dividend_yield": ["empresa_id", "tempo_id", "dy_12m"],
}
ACCEPTED_TICKER = ["stg_cotacoes", "stg_dividendos"]
UNIQUE = {
    "dim_empresa": ["empresa_id", "ticker"],
    "dim_tempo": ["tempo_id", "data"],
    "mart_indicadores_resumo": ["ticker"],
}
UNIQUE_COMBINATION = {
    "stg_cotacoes": ["ticker", "data"],
    "stg_dividendos": ["ticker", "data_ex"],
    "fato_cotacoes_diarias": ["empresa_id", "tempo_id"],
    "mart_indicadores_diarios": ["empresa_id", "tempo_id"],
    "mart_dividend_yield": ["empresa_id", "tempo_id"],
}
RELATIONSHIPS = {
    "fato_cotacoes_diarias": [("empresa_id", "dim_empresa"), ("tempo_id", "dim_tempo")],
    "fato_dividendos": [("empresa_id", "dim_empresa"), ("tempo_id", "dim_tempo")],
}


def run_checks(tables, tickers, whole=None):
    """Report of all declared checks: one row per check with its number of violations.

    All row-level checks of a table are counted in one pass over it; uniqueness and relationship
    checks take one aggregation or anti join each. ``tables`` should be written tables. Where they hold
    only the years a run has touched, ``whole`` has the tables that first sessions are looked up in.
    """
    reports, whole = [], whole or {}

    def report(table, names, counted):
        rows = F.array(*[
            F.struct(F.lit(n).alias("teste"), F.lit(table).alias("tabela"), F.col(f"c{i}").alias("violacoes"))
            for i, n in enumerate(names)
        ])
        reports.append(counted.select(F.inline(rows)))

    for table, df in tables.items():
        conditions = {f"not_null_{c}": F.col(c).isNull() for c in NOT_NULL[table]}
        if table in ACCEPTED_TICKER:
            conditions["accepted_values_ticker"] = _not_accepted("ticker", tickers)
        conditions |= row_rules(table)
        report(table, list(conditions), df.agg(
            *[F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions.values())]))

        grouped = {f"unique_{c}": unique(df, c) for c in UNIQUE.get(table, [])}
        if table in UNIQUE_COMBINATION:
            columns = UNIQUE_COMBINATION[table]
            grouped["unique_combination_" + "_".join(columns)] = unique_combination(df, columns)
        for column, parent in RELATIONSHIPS.get(table, []):
            grouped[f"relationships_{column}"] = relationships(df, column, tables[parent], column)
        if table == "mart_indicadores_diarios":
            grouped["retorno_primeiro_pregao_nulo"] = first_session_return(whole.get(table, df))
        for name, rows in grouped.items():
            report(table, [name], rows.agg(F.count(F.lit(1)).alias("c0")))

    combined = reports[0]
    for part in reports[1:]:
        combined = combined.unionByName(part)
    return combined.withColumn("aprovado", F.col("violacoes") == 0)
