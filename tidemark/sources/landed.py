"""Landed polls as a data source of their own, and JSON panels whose shape drifts.

Polls of a vendor land as folders ``poll=<n>`` of JSON lines with a ``_SUCCESS`` file, as Spark writes them. The source
``landed_polls`` reads them in partitions, opens only the polls that are asked for, and streams new ones by their number.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "poll long, tag string, x long, value double"
FILES_EACH = 4


def _files(path: str):
    """The file system of a path or URI and the path in it."""
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if re.match(r"^\w[\w+.-]*://", path) else (fs.LocalFileSystem(), path)


def landed_polls(path: str) -> dict[int, list[str]]:
    """The data files of every whole poll (one with ``_SUCCESS``), by its number."""
    from pyarrow import fs

    store, root = _files(path)
    found: dict[int, list[str]] = {}
    whole = set()
    for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        poll = re.search(r"/poll=(\d+)/([^/]+)$", info.path)
        if poll and info.type == fs.FileType.File:
            if poll[2] == "_SUCCESS":
                whole.add(int(poll[1]))
            elif not poll[2].startswith(("_", ".")):
                found.setdefault(int(poll[1]), []).append(info.path)
    return {n: sorted(found.get(n, [])) for n in sorted(whole)}


@dataclass
class Share(InputPartition):
    """Files of one poll that one task reads, and the only tags wanted (all, if None)."""

    poll: int
    files: tuple[str, ...]
    tags: frozenset[str] | None = None


def _shares(path: str, polls: list[int], tags: frozenset[str] | None, each: int) -> list[Share]:
    known = landed_polls(path)
    return [Share(n, tuple(known[n][k : k + each]), tags) for n in polls for k in range(0, len(known[n]), each)]


def _read(path: str, share: Share) -> Iterator[tuple]:
    """(poll, tag, x, value) of every point; failed responses and series and points without a value are left out."""
    store, _ = _files(path)
    for name in share.files:
        with store.open_input_stream(name) as file:
            for line in file.read().decode("utf-8", "replace").splitlines():
                try:
                    response = json.loads(line)
                except ValueError:
                    continue
                if not isinstance(response, dict) or str(response.get("status", "")).lower() == "error":
                    continue
                for tag, series in (response.get("body") or {}).items():
                    if not isinstance(series, dict) or series.get("type") == "ERROR" or share.tags is not None and tag not in share.tags:
                        continue
                    for x, value in zip(series.get("x") or [], series.get("c") or []):
                        if value is not None:
                            yield share.poll, tag, x, float(value)


class PollReader(DataSourceReader):
    """Reads whole polls: those from ``first`` to ``last``, and of them the ``tags`` (a JSON list), where these options are given.

    They are options and no pushed filters, as Spark 4.1 keeps a pushed filter with the table: another query of the same DataFrame
    would be answered with it.
    """

    def __init__(self, options: dict[str, str]):
        self.path, self.each = options["path"], int(options.get("filesEach", FILES_EACH))
        self.first, self.last = int(options.get("first", 0)), int(options["last"]) if "last" in options else None
        self.tags = frozenset(json.loads(options["tags"])) if "tags" in options else None

    def partitions(self) -> list[Share]:
        wanted = [n for n in landed_polls(self.path) if n >= self.first and (self.last is None or n <= self.last)]
        return _shares(self.path, wanted, self.tags, self.each) or [Share(-1, ())]

    def read(self, partition: Share) -> Iterator[tuple]:
        return _read(self.path, partition)


class PollStream(DataSourceStreamReader):
    """Streams polls in the order of their numbers. The offset is the number of the last poll, kept in the checkpoint: a restart
    goes on after it and repeats none.
    """

    def __init__(self, options: dict[str, str]):
        self.path, self.each = options["path"], int(options.get("filesEach", FILES_EACH))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"poll": -1}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"poll": max(landed_polls(self.path), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        return _shares(self.path, [n for n in landed_polls(self.path) if start["poll"] < n <= end["poll"]], None, self.each) or [Share(-1, ())]

    def read(self, partition: Share) -> Iterator[tuple]:
        return _read(self.path, partition)

    def commit(self, end: dict) -> None:
        pass


class LandedPolls(DataSource):
    """``spark.read.format("landed_polls").load(path)``, or ``readStream``; columns poll, tag, x, value."""

    @classmethod
    def name(cls) -> str:
        return "landed_polls"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PollReader:
        return PollReader(self.options)

    def streamReader(self, schema) -> PollStream:  # noqa: N802
        return PollStream(self.options)


def poll_frame(spark: SparkSession, path: str, *, stream: bool = False, first: int = 0, last: int | None = None, tags: list[str] | None = None, files_each: int = FILES_EACH) -> DataFrame:
    """The points of all landed polls, as a table or as a stream that takes each poll once.

    A table may be of some polls or tags only: then other files are not opened, and points of other tags do not leave the source.
    """
    spark.dataSource.register(LandedPolls)
    if stream:
        return spark.readStream.format("landed_polls").option("filesEach", files_each).load(path)
    reader = spark.read.format("landed_polls").option("filesEach", files_each).option("first", first)
    reader = reader if last is None else reader.option("last", last)
    return (reader if tags is None else reader.option("tags", json.dumps(tags))).load(path)


def drifting_panel(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, bad lines) of JSON lines of any shape: ``record`` is a VARIANT, ``line`` what does not parse; blank lines are neither."""
    lines = spark.read.text(path).where("trim(value) != ''").withColumn("record", F.try_parse_json("value"))
    return lines.where("record is not null").select("record"), lines.where("record is null").select(F.col("value").alias("line"))


def variant_field(record: Column, paths: list[str], kind: str) -> Column:
    """The first of several places in a VARIANT that holds a value of the kind; null if none does."""
    return F.coalesce(*[F.try_variant_get(record, path, kind) for path in paths])


def panel_shape(records: DataFrame) -> DataFrame:
    """One row: the schema that all records have in common, as DDL (an object's missing fields are in it, unlike kinds are VARIANT)."""
    return records.agg(F.schema_of_variant_agg("record").alias("shape"))


def variant_series(df: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """Points of a VARIANT map of series, whatever the shape of each: (keys, tag, place, x, value).

    A series is an object of arrays x and c, an array of [x, c] pairs, or one number (x is null). Others, and null points, give no rows.
    """
    spark = df.sparkSession
    series = df.lateralJoin(spark.tvf.variant_explode(F.col(body).outer())).select(*keys, F.col("key").alias("tag"), F.col("value").alias("s")).where("tag is not null")
    xs, cs = F.try_variant_get("s", "$.x", "array<variant>"), F.try_variant_get("s", "$.c", "array<variant>")
    pairs = F.try_variant_get("s", "$", "array<variant>")
    single = F.try_variant_get("s", "$", "double")
    point = lambda x, c: F.struct(x.alias("x"), c.alias("value"))
    points = F.when(cs.isNotNull(), F.zip_with(xs, cs, lambda x, c: point(F.try_variant_get(x, "$", "long"), F.try_variant_get(c, "$", "double"))))
    points = points.when(pairs.isNotNull(), F.transform(pairs, lambda p: point(F.try_variant_get(p, "$[0]", "long"), F.try_variant_get(p, "$[1]", "double"))))
    points = points.when(single.isNotNull(), F.array(point(F.lit(None).cast("long"), single)))
    return series.select(*keys, "tag", F.posexplode(points).alias("place", "p")).select(*keys, "tag", "place", "p.x", "p.value").where("value is not null")
