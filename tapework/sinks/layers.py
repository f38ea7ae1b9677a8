"""Named layers: views that are evaluated per read, tables that are refreshed in full."""

from tapework.schemas import PRICE_COLUMNS, QUOTES

# Bodies of the permanent views; {raw} and {marts} are the layers they read.
VIEWS = {
    "stg_cotacoes": f"SELECT {', '.join(QUOTES.names)} FROM {{raw}}.cotacoes WHERE fechamento_ajustado IS NOT NULL AND "
                    + " AND ".join(f"{c} > 0" for c in PRICE_COLUMNS[:3]),
    "stg_dividendos": "SELECT data_ex, ticker, valor_dividendo FROM {raw}.dividendos WHERE valor_dividendo > 0",
    "fato_dividendos": "SELECT e.empresa_id, t.tempo_id, d.valor_dividendo FROM {staging}.stg_dividendos d "
                       "JOIN {marts}.dim_empresa e ON e.ticker = d.ticker JOIN {marts}.dim_tempo t ON t.data = d.data_ex",
}


def create_layer(spark, layer, path):
    """Idempotent namespace whose tables live under ``path``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION '{path}/{layer}'")


def register(df, layer, name, path, partitions):
    """Table of a layer over the Parquet files under ``path`` that a load keeps up to date; ``df`` gives
    its columns, of which ``partitions`` are folders."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{layer}`.`{name}`")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    by = f"PARTITIONED BY ({', '.join(partitions)})"
    spark.sql(f"CREATE TABLE `{layer}`.`{name}` ({columns}) USING parquet {by} LOCATION '{path}'")
    if df.inputFiles():  # nothing is stored before the first load
        spark.sql(f"MSCK REPAIR TABLE `{layer}`.`{name}`")
    return spark.table(f"{layer}.{name}")


def create_view(spark, layer, name, layers):
    """Permanent view ``layer.name``: every session of the catalog can read it after the run ended."""
    spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS {VIEWS[name].format(**layers)}")
    return spark.table(f"{layer}.{name}")


def materialize(df, layer, name, kind, path=None):
    """``view``: replace a temporary view. ``table``: overwrite ``path/layer/name`` and read it."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(f"{layer}_{name}")
        return spark.table(f"{layer}_{name}")
    if kind == "table":
        df.write.mode("overwrite").option("path", f"{path}/{layer}/{name}").saveAsTable(f"{layer}.{name}")
        return spark.table(f"{layer}.{name}")
    raise ValueError(f"unknown kind {kind!r}")
