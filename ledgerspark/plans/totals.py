"""Totals per taxpayer and ticker, kept up to date by the rows that imports add.

Prices of all tickers need a pass over all trades; what an import adds to them does not. Each refresh adds up the rows
of the imports that the stored totals do not have yet, and appends the result: a few rows per ticker, whatever the
history. The names of these imports are written by the same job, so an import is in the totals as a whole or not at
all, and a refresh that failed can be repeated. Readers add the parts up.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.operators.position import TICKER_TOTALS, added_up, ticker_totals
from ledgerspark.schemas import TAXPAYER, table_spec
from ledgerspark.session import remove_dir
from ledgerspark.sources.tables import BUCKET, INGEST_RUN, bucket_of, stored_rows

TOTALS, RUNS = "totais_por_ticker", "importacoes"
#: Tables whose rows are added up.
SOURCES = ("b3_negociacao", "b3_movimentacao", "b3_bonificacao_acoes")
_RUN = "run"
_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in (TAXPAYER, "instrumento", _RUN)]
    + [T.StructField(n, t) for n, t in TICKER_TOTALS.items()]
    + [T.StructField(BUCKET, T.IntegerType())]
)


def _path(tables_dir: str, name: str) -> str:
    return f"{tables_dir.rstrip('/')}/{name}"


def _read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _names(df: DataFrame | None) -> set[str]:
    """Names of imports, one for each."""
    return set() if df is None else {r[0] for r in df.filter(F.col(_RUN).isNotNull()).select(_RUN).distinct().collect()}


def log_run(spark: SparkSession, tables_dir: str, run: str) -> None:
    """Note that an import is complete."""
    spark.createDataFrame([(run,)], f"{_RUN} string").coalesce(1).write.mode("append").parquet(_path(tables_dir, RUNS))


def forbid_counted_run(spark: SparkSession, tables_dir: str, run: str) -> None:
    """An import under a name that the totals have would add rows that they never get."""
    if run in _names(_read(spark, _path(tables_dir, TOTALS), _SCHEMA)):
        raise ValueError(f"import {run!r} is in the totals already; give the new one a name of its own")


def refresh_totals(spark: SparkSession, tables_dir: str) -> int:
    """Bring complete imports that are missing into the totals; gives their number.

    Rows of an import are found by the file statistics of its name: files of other imports are skipped.
    """
    path = _path(tables_dir, TOTALS)
    done = _names(_read(spark, path, _SCHEMA))
    pending = sorted(_names(_read(spark, _path(tables_dir, RUNS), f"{_RUN} string")) - done)
    if not pending:
        return 0
    sources = []
    for name in SOURCES:
        spec = table_spec(name)
        rows = stored_rows(spark, _path(tables_dir, name), spec)
        sources.append(spark.createDataFrame([], spec.schema) if rows is None else rows.filter(F.col(INGEST_RUN).isin(pending)))
    parts = ticker_totals(*sources).withColumn(BUCKET, bucket_of(F.col(TAXPAYER)))
    marks = spark.createDataFrame([(run, 0) for run in pending], f"{_RUN} string, {BUCKET} int")
    both = parts.unionByName(marks, allowMissingColumns=True).select(*_SCHEMA.names)
    both.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)
    return len(pending)


def stored_totals(spark: SparkSession, tables_dir: str, taxpayer: str | None = None) -> DataFrame:
    """Totals per ticker of all imports so far, of one taxpayer if given."""
    parts = _read(spark, _path(tables_dir, TOTALS), _SCHEMA)
    if parts is None:
        raise FileNotFoundError(f"no totals in {tables_dir}: refresh them first")
    if taxpayer is not None:
        parts = parts.filter((F.col(BUCKET) == bucket_of(F.lit(taxpayer))) & (F.col(TAXPAYER) == taxpayer))
    return added_up(parts.filter(F.col(_RUN).isNull()))


def drop_totals(spark: SparkSession, tables_dir: str) -> None:
    """Forget the totals, for instance after rows were replaced; the next refresh adds up everything."""
    remove_dir(spark, _path(tables_dir, TOTALS))
