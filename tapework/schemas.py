"""Column contracts of every table, in order, with Spark types."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_DATE, _STR, _DBL, _LONG, _INT, _BOOL = (
    T.DateType(), T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType(),
)

# Column names, suffix and vendor metric names of the input contract.
PRICE_COLUMNS = ["abertura", "maxima", "minima", "fechamento", "fechamento_ajustado"]
VENDOR_METRICS = {
    "Open": "abertura",
    "High": "maxima",
    "Low": "minima",
    "Close": "fechamento",
    "Adj Close": "fechamento_ajustado",
    "Volume": "volume",
}
EXCHANGE_SUFFIX = ".SA"
# Partition columns of each write granularity; "day" is the layout of the raw layer.
GRANULARITY = {"day": ["ano", "mes", "dia"], "month": ["ano", "mes"], "year": ["ano"]}
EXCHANGE_ZONE = "America/Sao_Paulo"

QUOTES = _struct(
    ("data", _DATE), ("ticker", _STR), *[(c, _DBL) for c in PRICE_COLUMNS], ("volume", _LONG),
)
QUOTE_PARTITIONS = _struct(("ano", _INT), ("mes", _INT), ("dia", _INT))
RAW_QUOTES = T.StructType(QUOTES.fields + QUOTE_PARTITIONS.fields)

DIVIDENDS = _struct(("data_ex", _DATE), ("ticker", _STR), ("valor_dividendo", _DBL))
DIVIDEND_PARTITIONS = _struct(("ano", _INT))
RAW_DIVIDENDS = T.StructType(DIVIDENDS.fields + DIVIDEND_PARTITIONS.fields)

COMPANIES = _struct(
    ("ticker", _STR), ("nome", _STR), ("setor", _STR), ("subsetor", _STR), ("segmento", _STR),
)
DIM_COMPANY = T.StructType([T.StructField("empresa_id", _LONG, True)] + COMPANIES.fields)
DIM_CALENDAR = _struct(
    ("tempo_id", _INT), ("data", _DATE), ("ano", _LONG), ("mes", _LONG), ("dia", _LONG),
    ("dia_semana", _LONG), ("trimestre", _LONG), ("nome_mes", _STR), ("nome_dia_semana", _STR),
    ("eh_fim_semana", _BOOL), ("eh_inicio_mes", _BOOL), ("eh_fim_mes", _BOOL),
)
FACT_QUOTES = _struct(
    ("empresa_id", _LONG), ("tempo_id", _INT), *[(c, _DBL) for c in PRICE_COLUMNS], ("volume", _LONG),
)
FACT_DIVIDENDS = _struct(("empresa_id", _LONG), ("tempo_id", _INT), ("valor_dividendo", _DBL))


def empty(spark, schema):
    """Relation without rows that keeps its schema."""
    return spark.createDataFrame([], schema)


def schema_problems(df, expected):
    """Driver-side description of how ``df`` departs from the contract ([] when it conforms)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    missing = sorted(set(want) - set(have))
    if missing:
        return [f"missing columns: {missing}"]
    if df.columns != expected.names:
        return [f"column order {df.columns}, expected {expected.names}"]
    return [
        f"{name}: {have[name].simpleString()}, expected {kind.simpleString()}"
        for name, kind in want.items() if have[name] != kind
    ]


def assert_schema(df, expected):
    problems = schema_problems(df, expected)
    if problems:
        raise ValueError("; ".join(problems))
    return df
