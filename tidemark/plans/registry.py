"""All registered queries on the given tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The given tables by name; timestamps without a zone are read as instants of the session's zone."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})


def query(sql: str | None = None, dates: tuple[str, ...] = ()) -> Callable:
    """Register a function of ``Tables`` under its name, with its SQL if SQL can express it.

    The columns in ``dates`` leave both sides as text, as engines hand out dates in different types.
    """

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            out = f(Tables(spark, sf_dir))
            return out.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else out

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLE_SQL[f.__name__] = f"SELECT * REPLACE ({', '.join(f'{c}::VARCHAR AS {c}' for c in dates)}) FROM ({sql}) AS q" if dates else sql
        return f

    return add


def stamp(c: str) -> F.Column:
    """An instant as text to the second, for results."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


from tidemark.plans import calendar_queries, landed_queries, market_queries, more_queries, report_queries, series_queries, source_queries, stream_queries, table_queries  # noqa: E402,F401  registers the queries
