"""Reading landed files and tables: range scans, multi-header sheets, vendor responses, partitioned archives."""

from __future__ import annotations

import re
import time
import uuid
from datetime import date, timedelta

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.parse import forward_points, mid_of, yes_no_prices


def date_range_scan(df: DataFrame, date: str, start: Column, end: Column, columns: list[str] | None = None) -> DataFrame:
    """A1: rows from ``start`` to ``end``, both included, in date order."""
    return df.select(*(columns or df.columns)).where(F.col(date).between(start, end)).orderBy(date)


def read_view(df: DataFrame, filters: dict[str, object], order_by: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """A2: equality filters, order and a row limit."""
    for name, value in filters.items():
        df = df.where(F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
    df = df.orderBy(*order_by) if order_by else df
    return df if limit is None else df.limit(limit)


def sql_frame(spark: SparkSession, sql: str, args: dict[str, object] | None = None, **frames: DataFrame) -> DataFrame:
    """A3: a SQL text over named frames (``{name}``) with bound parameters (``:name``)."""
    return spark.sql(sql, args=args or {}, **frames)


#: Lines of a parsed plan: the table of a relation, a table function, and statements that are no query.
_RELATION = re.compile(r"^[\s:+|-]*'?UnresolvedRelation \[([^\]]*)\]", re.M)
_TABLE_FUNCTION = re.compile(r"^[\s:+|-]*'?UnresolvedTableValuedFunction \[([^\]]*)\]", re.M)
_STATEMENT = re.compile(r"^[\s:+|-]*'?(\w*Command|Insert\w*|Create\w*|Replace\w*|Drop\w*|Alter\w*|Add\w*|Rename\w*|Delete\w*|Update\w*|Merge\w*|Truncate\w*|Cache\w*|Uncache\w*|Refresh\w*|Set[A-Z]\w*|Show\w*|Describe\w*|Load\w*|Call\w*|Analyze\w*)\b", re.M)
_CTE = re.compile(r"^[\s:+|-]*'?(?:UnresolvedWith|CTE) \[([^\]]*)\]", re.M)
_OUTSIDE_CODE = re.compile(r"'(?:java_method|reflect|try_reflect)\(")
_TABLE_FUNCTIONS = {"range", "explode", "explode_outer", "inline", "inline_outer", "posexplode", "posexplode_outer", "stack", "json_tuple"}


def query_tables(spark: SparkSession, sql: str) -> set[str]:
    """A4: the tables that a query names, wherever it does; anything but one SELECT or WITH query raises ``ValueError``.

    Both come from the plan into which Spark parses the text, without running it, so quoted names, comma joins and subqueries
    count and words inside strings and comments do not.
    """
    text = re.sub(r"\A(?:\s|--[^\n]*\n|/\*.*?\*/)*", "", sql, flags=re.S)
    if not re.match(r"(?i)(select|with)\b", text):
        raise ValueError("only a single SELECT or WITH query is allowed")
    try:
        plan = spark.sql(f"EXPLAIN EXTENDED {text}").first()[0]
    except ParseException as e:
        raise ValueError("only a single SELECT or WITH query is allowed") from e
    parsed = plan.partition("== Parsed Logical Plan ==")[2].partition("== Analyzed Logical Plan ==")[0]
    if statement := _STATEMENT.search(parsed):
        raise ValueError(f"the query may not change anything: {statement[1]}")
    if _OUTSIDE_CODE.search(parsed) or any(f.split(",")[-1].strip().lower() not in _TABLE_FUNCTIONS for f in _TABLE_FUNCTION.findall(parsed)):
        raise ValueError("the query calls a function that is not allowed")
    own = {name.strip().lower() for names in _CTE.findall(parsed) for name in names.split(",")}
    named = {".".join(part.strip() for part in name.split(",")).lower() for name in _RELATION.findall(parsed)}
    return named - own


def guarded_query(spark: SparkSession, sql: str, allowed: set[str] | None = None, max_rows: int = 500) -> DataFrame:
    """A SELECT or WITH query over allowed views only, with a row cap; anything else raises ``ValueError``.

    A name that the query gives to a common table expression is its own; other names must be allowed.
    """
    used = query_tables(spark, sql)
    if allowed is not None and not used <= {a.lower() for a in allowed}:
        raise ValueError(f"not allowed: {sorted(used - {a.lower() for a in allowed})}")
    return spark.sql(sql.strip().rstrip(";")).limit(max_rows)


LOG_SCHEMA = "sql_text string, called_by string, row_count long, execution_ms long, error_message string"


def logged_query(spark: SparkSession, sql: str, log: str, *, called_by: str, allowed: set[str] | None = None, max_rows: int = 500) -> DataFrame:
    """A4: ``guarded_query`` with a row in the Parquet log for each call, refused and failed ones too, which then raise.

    The rows are few (``max_rows``), so they are fetched once and handed back as they were counted.
    """
    began, rows, error = time.monotonic(), None, None
    try:
        found = guarded_query(spark, sql, allowed, max_rows)
        rows = found.collect()
        return spark.createDataFrame(rows, found.schema)
    except Exception as e:
        error = str(e)[:2000]
        raise
    finally:
        entry = (sql[:4000], called_by, None if rows is None else len(rows), int(1000 * (time.monotonic() - began)), error)
        spark.createDataFrame([entry], LOG_SCHEMA).write.mode("append").parquet(log)


def catalog_columns(spark: SparkSession, database: str | None = None, tables: set[str] | None = None) -> DataFrame:
    """A5: a row for each column of the catalog's tables and views: table, kind, place, column, type, nullable and the table's rows."""
    found, counts = [], None
    for table in spark.catalog.listTables(database):
        if tables is not None and table.name not in tables:
            continue
        name = ".".join(f"`{part}`" for part in [*([] if table.isTemporary or not table.namespace else table.namespace), table.name])
        found += [(table.name, table.tableType, k, c.name, c.dataType, c.nullable) for k, c in enumerate(spark.catalog.listColumns(name))]
        one = spark.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(table.name).alias("table_name"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    schema = "table_name string, kind string, place int, column_name string, data_type string, nullable boolean"
    columns = spark.createDataFrame(found, schema)
    return columns.withColumn("n_rows", F.lit(None).cast("long")) if counts is None else columns.join(counts, "table_name")


def describe_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """A5: a row for each column of each table: table, place, column, type."""
    rows = [(name, k, c, t) for name, df in tables.items() for k, (c, t) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "table_name string, place int, column_name string, data_type string")


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """A5: columns and rows of each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("n_columns"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def partitioned_scan(spark: SparkSession, path: str, partitions: dict[str, list], *, date: str | None = None, start: Column | None = None, end: Column | None = None, dim: DataFrame | None = None, on: list[str] | None = None, label: str | None = None) -> DataFrame:
    """Rows of a partitioned archive by partition values and dates, with a label from a dimension ("unknown" without one).

    The values select folders before any file is opened; the dates are pushed down to the files.
    """
    df = spark.read.parquet(path)
    for name, values in partitions.items():
        df = df.where(F.col(name).isin(*values))
    if date is not None:
        df = df.where(F.col(date).between(start, end))
    return df if dim is None else df.join(dim.select(*on, label), on, "left").withColumn(label, F.coalesce(label, F.lit("unknown")))


#: A record of a CSV file (line ends inside quotes do not end it) and a cell of a record.
_RECORD, _CELL = r'([^"\r\n]*+(?:"[^"]*+"[^"\r\n]*+)*+)', r'(?:^|,)((?:"[^"]*+")++|[^,]*+)'


def three_header_csv(spark: SparkSession, paths: str | list[str], *, corner: str | None = None, second: str | None = None, encoding: str = "ISO-8859-1") -> DataFrame:
    """Files with three header rows (ticker, alias, field) and then dd/mm/yyyy dates, as (path, obs_date, column, alias, field, value).

    Each file is read whole by one task; unreadable dates and values are dropped, cells may be quoted. A file of fewer than four
    rows fails the job, and so does one whose first cells of the first two rows are not ``corner`` and ``second`` where given.
    """
    paths = [paths] if isinstance(paths, str) else paths
    whole = spark.read.format("binaryFile").load(paths).select("path", F.decode("content", encoding).alias("value"))
    records = F.filter(F.regexp_extract_all("value", F.lit(_RECORD), F.lit(1)), lambda x: F.trim(x) != "")
    bare = lambda x: F.when(x.startswith('"'), F.replace(F.regexp_replace(x, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(x)
    cut = lambda line: F.transform(F.regexp_extract_all(line, F.lit(_CELL), F.lit(1)), lambda x: F.trim(bare(x)))
    row = lambda k: F.coalesce(cut(F.get("lines", F.lit(k))), F.array().cast("array<string>"))
    heads = whole.select("path", records.alias("lines")).select("path", "lines", row(0).alias("tickers"), row(1).alias("aliases"), row(2).alias("fields"))
    wrong = F.when(F.size("lines") < 4, F.concat("path", F.lit(": fewer than four rows")))
    for names, expected in (("tickers", corner), ("aliases", second)):
        if expected is not None:
            wrong = wrong.when(~F.get(names, F.lit(0)).eqNullSafe(F.lit(expected)), F.concat("path", F.lit(f": the first cell of {names} is not {expected}")))
    heads = heads.where(F.when(wrong.isNotNull(), F.raise_error(wrong)).otherwise(F.lit(True)).cast("boolean"))
    rows = heads.select("path", "tickers", "aliases", "fields", F.explode(F.slice("lines", F.lit(4), F.greatest(F.size("lines") - 3, F.lit(0)))).alias("line"))
    cells = rows.withColumn("cells", cut(F.col("line"))).select("path", "tickers", "aliases", "fields", F.try_to_date(F.get("cells", F.lit(0)), "dd/MM/yyyy").alias("obs_date"), F.posexplode("cells").alias("k", "text"))
    at = lambda names: F.get(names, F.col("k"))
    out = cells.where("k > 0").select("path", "obs_date", at("tickers").alias("ticker"), at("aliases").alias("alias"), at("fields").alias("field"), F.col("text").try_cast("double").alias("value"))
    return out.where("obs_date is not null and value is not null")


def sheet_quotes(cells: DataFrame, bid_field: str, ask_field: str, spot: DataFrame | None = None) -> DataFrame:
    """Bid, ask and mid of each file, date and alias of a long sheet; with ``spot`` (obs_date, spot) also the points.

    Rows without a spot that day are dropped then. A quote with one side takes that side as its mid.
    """
    side = lambda name: F.max(F.when(F.col("field") == name, F.col("value")))
    quotes = cells.groupBy("path", "obs_date", "alias").agg(side(bid_field).alias("bid"), side(ask_field).alias("ask"))
    quotes = quotes.withColumn("mid", mid_of(F.col("bid"), F.col("ask"), zero_is_missing=False))
    return quotes if spot is None else quotes.join(spot, "obs_date").withColumn("points", forward_points(F.col("mid"), F.col("spot"), 1))


def folder_axes(path: Column) -> list[Column]:
    """(ccy, curve, curve_type) from a folder named like ``USD_SOFR_ois``."""
    folder = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return [F.regexp_extract(folder, rf"^(?:[^_]+_){{{k}}}([^_]+)", 1).alias(n) for k, n in enumerate(("ccy", "curve", "curve_type"))]


def live_only(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    """The rows of each key's newest date."""
    last = F.max(date).over(Window.partitionBy(*keys))
    return df.withColumn("__last", last).where(F.col(date) == F.col("__last")).drop("__last")


def series_response(df: DataFrame, body: str = "body", status: str = "status") -> DataFrame:
    """A map of tags to x and c arrays as (tag, x, value): failed responses and series and null points are left out."""
    tags = df.where(F.lower(status) != "error").select(F.explode(body).alias("tag", "s")).where(F.coalesce(F.col("s.type"), F.lit("")) != "ERROR")
    return tags.select("tag", F.explode(F.arrays_zip(F.col("s.x").alias("x"), F.col("s.c").alias("c"))).alias("p")).select("tag", "p.x", F.col("p.c").alias("value")).where("value is not null")


def exploded_markets(df: DataFrame, keys: list[str], markets: str, prices: str) -> DataFrame:
    """A row for each nested market with its fields, and the yes and no price of its JSON list."""
    one = df.select(*keys, F.explode(markets).alias("__m")).select(*keys, "__m.*")
    yes, no = yes_no_prices(F.col(prices))
    return one.withColumns({"yes": yes, "no": no}).drop(prices)


def landed_responses(spark: SparkSession, path: str) -> DataFrame:
    """All landed responses of a folder, in whatever batches they came, as (tag, x, value)."""
    body = "map<string, struct<type: string, x: array<bigint>, c: array<double>>>"
    return series_response(spark.read.schema(f"status string, body {body}").json(path))


def json_panel(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, unreadable lines) of a JSON-lines panel."""
    rows = spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    return rows.where("_corrupt_record is null").drop("_corrupt_record"), rows.where("_corrupt_record is not null").select("_corrupt_record")


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], keys: list[str], required: list[str], order: list[str] | None = None) -> None:
    """Upsert into a partitioned Parquet archive: only touched partitions are read and written again, the last arrival of a key wins.

    New rows come after stored ones; of equal keys in ``df`` the one of the largest ``order`` columns, or without them the last one in the
    order in which ``df`` is read. Nothing is overwritten until the new partitions are staged beside the archive, in a folder
    of this call's own that is removed however the call ends.
    """
    spark = df.sparkSession
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    arrival = F.struct(*order) if order else F.struct(F.monotonically_increasing_id().alias("at"))
    last = F.struct(F.lit(1).alias("new"), arrival.alias("arrival"))
    new = df.withColumn("__seq", last)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(fs_path):
        never = F.struct(F.lit(0).alias("new"), F.lit(None).cast(df.select(arrival).schema[0].dataType).alias("arrival"))
        stored = spark.read.schema(df.schema).parquet(path).join(df.select(*partition_by).distinct(), partition_by, "left_semi").withColumn("__seq", never)
        new = stored.unionByName(new)
    rest = [c for c in df.columns if c not in keys]
    merged = new.groupBy(*keys).agg(F.max_by(F.struct(*rest), "__seq").alias("__row")).select(*keys, "__row.*")
    staged = f"{path.rstrip('/')}__staged-{uuid.uuid4().hex}"
    try:
        merged.select(*df.columns).write.parquet(staged)
        spark.read.schema(df.schema).parquet(staged).repartition(*partition_by).sortWithinPartitions(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    finally:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(staged), True)


def manifest(df: DataFrame, partition_by: list[str], date: str) -> DataFrame:
    """Rows, first and last date of each partition."""
    return df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n_rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def write_pair(dim: DataFrame, fact: DataFrame, path: str, stamp: str) -> None:
    """A dimension and its facts under one load stamp, never over an earlier pair."""
    dim.write.mode("errorifexists").parquet(f"{path}/dim/load={stamp}")
    fact.write.mode("errorifexists").parquet(f"{path}/fact/load={stamp}")


def latest_pair(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The dimension and the facts of the newest load stamp for which both were written."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [{s.getPath().getParent().getName() for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, f"{kind}/load=*/_SUCCESS"))} for kind in ("dim", "fact")]
    newest = max(done[0] & done[1])
    return spark.read.parquet(f"{path}/dim/{newest}"), spark.read.parquet(f"{path}/fact/{newest}")


def migrate_bars(df: DataFrame, renames: dict[str, str], required: list[str], symbol: str = "symbol") -> DataFrame:
    """Columns renamed and put in order, dots stripped from symbols; a missing column raises."""
    out = df.withColumnsRenamed(renames)
    missing = [c for c in required if c not in out.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return out.withColumn(symbol, F.regexp_replace(symbol, r"\.", "")).select(*required)


def expired_partitions(df: DataFrame, partition: str, today: Column, months: int) -> DataFrame:
    """Partitions (yyyy-MM) that end before a cutoff of 30 days a month."""
    ends = F.last_day(F.to_date(F.concat(F.col(partition), F.lit("-01"))))
    return df.select(partition).distinct().where(ends < F.date_sub(today, 30 * months))


def drop_expired(spark: SparkSession, path: str, partition: str, today: date, months: int, *, dry_run: bool = True) -> DataFrame:
    """Removes the folders of partitions (yyyy-MM) that end before a cutoff of 30 days a month: ``folder, n_files, n_bytes, dropped``.

    The partition column may lie at any depth. Folders whose value is no month stay. With ``dry_run`` nothing is removed. The report is a
    row for each expired folder, from the names alone: no file is opened.
    """
    cutoff = today - timedelta(days=30 * months)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found, level = [], [root]
    while level:
        inner = []
        for folder in level:
            for status in fs.listStatus(folder):
                name = status.getPath().getName()
                if not status.isDirectory() or name.startswith(("_", ".")):
                    continue
                month = re.fullmatch(rf"{re.escape(partition)}=(\d{{4}})-(0[1-9]|1[0-2])", name)
                if month is None:
                    inner.append(status.getPath())
                    continue
                following = date(int(month[1]) + int(month[2]) // 12, int(month[2]) % 12 + 1, 1)
                if following - timedelta(days=1) < cutoff:
                    size = fs.getContentSummary(status.getPath())
                    gone = not dry_run and fs.delete(status.getPath(), True)
                    found.append((status.getPath().toString(), size.getFileCount(), size.getLength(), bool(gone)))
        level = inner
    return spark.createDataFrame(found, "folder string, n_files long, n_bytes long, dropped boolean")


def normalised_union(frames: list[DataFrame], mappings: list[dict[str, str]]) -> DataFrame:
    """Frames with different headers as one schema; what a frame lacks is null."""
    out = None
    for df, names in zip(frames, mappings, strict=True):
        part = df.select(*[F.col(old).alias(new) for old, new in names.items()])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def failed_runs(log: DataFrame, run: str, category: str, target: str, wanted: str) -> DataFrame:
    """Runs with an error of a category, and the date that they were for."""
    return log.groupBy(run).agg(F.max(F.when(F.col(category) == wanted, 1).otherwise(0)).alias("__hit"), F.max(target).alias("target_date")).where("__hit = 1").drop("__hit")


def fetch_window(df: DataFrame, ts: str, target: str, lookback_days: int, fetch_from: str | None = None, date_given: bool = False) -> DataFrame:
    """Rows from an explicit start, else of the target day only if a date was given, else from so many days back."""
    start = F.lit(fetch_from).cast("date") if fetch_from else F.lit(target).cast("date") if date_given else F.date_sub(F.lit(target).cast("date"), lookback_days)
    return df.where(F.col(ts).cast("date").between(start, F.lit(target).cast("date")))
