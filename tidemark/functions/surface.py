"""Functions and table functions that SQL texts can call, and callables as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import StringType, StructType

#: SQL functions by name: arguments, result type and body. Spark puts the body into the plan, so nothing leaves the JVM.
SQL_FUNCTIONS = {
    "fx_open": ("ts TIMESTAMP", "BOOLEAN", "CASE weekday(ts) WHEN 6 THEN hour(ts) >= 21 WHEN 4 THEN hour(ts) < 21 WHEN 5 THEN false ELSE ts IS NOT NULL END"),
    "tag_part": ("tag STRING, place INT", "STRING", "get(split(tag, '\\\\.'), place - 1)"),
    "spread_bps": ("bid DOUBLE, ask DOUBLE", "DOUBLE", "(ask - bid) / nullif((ask + bid) / 2, 0) * 10000"),
    "mid_price": ("bid DOUBLE, ask DOUBLE", "DOUBLE", "coalesce((bid + ask) / 2, bid, ask)"),
}


@udtf
class TagAxes:
    """The dotted parts of a tag as columns: ``SELECT ... FROM t, LATERAL tag_axes(tag, 'ccy.curve.tenor')``.

    The second argument, a constant, names the columns, and ``analyze`` makes them the table's schema. A tag with another number of
    parts gives one row of nulls, a null tag none.
    """

    @staticmethod
    def analyze(tag: AnalyzeArgument, names: AnalyzeArgument) -> AnalyzeResult:
        if names.value is None or not str(names.value).strip("."):
            raise ValueError("the names of the axes must be a constant text such as 'ccy.curve.tenor'")
        schema = StructType()
        for name in str(names.value).split("."):
            schema = schema.add(name, StringType())
        return AnalyzeResult(schema)

    def eval(self, tag: str, names: str) -> Iterator[tuple]:
        if tag is not None:
            parts, wanted = tag.split("."), names.split(".")
            yield tuple(parts) if len(parts) == len(wanted) else (None,) * len(wanted)


def register_functions(spark: SparkSession) -> None:
    """Make the functions of this module known to the session's SQL."""
    for name, (arguments, kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    spark.udtf.register("tag_axes", TagAxes)


def column_of(rule: Callable, kind: str, *columns: Column | str) -> Column:
    """A callable as a column. One that builds a ``Column`` from columns stays in the JVM; any other is called for each row, by Arrow batches.

    A callable that works on values says so by refusing columns (any exception) or by returning none.
    """
    given = [F.col(c) if isinstance(c, str) else c for c in columns]
    try:
        built = rule(*given)
    except Exception:  # it wants values
        built = None
    if isinstance(built, Column):
        return built.cast(kind)
    return F.udf(rule, kind, useArrow=True)(*given)
