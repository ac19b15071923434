"""Approximate vector search by tables of bucketed random projections, kept on disk by bucket."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.documents import cosine

FOLDERS = 64


def _unit(vector: str) -> Column:
    """The vector scaled to length one, as a vector column; near unit vectors have large cosines."""
    v = F.col(vector).cast("array<double>")
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return array_to_vector(F.transform(v, lambda x: x / length))


def _usable(vector: str) -> Column:
    v = F.col(vector)
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)


@dataclass(frozen=True)
class VectorIndex:
    """Where an index lies: its rows once for each table, in folders by table and part of the buckets, and its projections; ``columns`` as DDL."""

    path: str
    vector: str
    columns: str

    def model(self) -> BucketedRandomProjectionLSHModel:
        return BucketedRandomProjectionLSHModel.load(f"{self.path}/model")

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{self.columns}, lsh_bucket long, lsh_table int, lsh_part long").parquet(f"{self.path}/rows")


def build_index(chunks: DataFrame, path: str, *, vector: str = "vector", tables: int = 8, bucket_length: float = 0.5, seed: int = 5) -> VectorIndex:
    """Write an index of all rows with a usable vector, with all their columns.

    Each table puts a row into the bucket of one random projection of its unit vector. Rows lie sorted by bucket in folders of
    (table, bucket mod ``FOLDERS``), so a search reads only the folders and row groups of the buckets that it asks for. Vectors that are null, zero or
    hold null or non-finite numbers have no cosine and are left out. Longer buckets find more and read more.
    """
    good = chunks.where(_usable(vector))
    size = good.select(F.size(vector)).first()
    model = BucketedRandomProjectionLSH(inputCol="__unit", outputCol="__hashes", numHashTables=tables, bucketLength=bucket_length, seed=seed)
    width = size[0] if size else 1
    fitted = model.fit(chunks.sparkSession.range(1).select(array_to_vector(F.array_repeat(F.lit(1.0), width)).alias("__unit")))  # takes the width only
    hashed = fitted.transform(good.withColumn("__unit", _unit(vector))).drop("__unit")
    buckets = F.transform("__hashes", lambda h: F.element_at(vector_to_array(h), 1).cast("long"))
    rows = hashed.select(*chunks.columns, F.posexplode(buckets).alias("lsh_table", "lsh_bucket")).withColumn("lsh_part", F.pmod("lsh_bucket", F.lit(FOLDERS)))
    rows.repartition("lsh_table", "lsh_part", F.pmod(F.xxhash64(*[c for c in chunks.columns if c != vector]), F.lit(8))).sortWithinPartitions("lsh_table", "lsh_part", "lsh_bucket").write.partitionBy("lsh_table", "lsh_part").parquet(f"{path}/rows")
    fitted.write().save(f"{path}/model")
    return VectorIndex(path, vector, ", ".join(f"`{name}` {kind}" for name, kind in chunks.dtypes))


def candidates(spark: SparkSession, index: VectorIndex, query: list[float], *, where: Column | None = None, probes: int = 1) -> DataFrame:
    """The rows in the query's bucket, or up to ``probes`` buckets beside it, in any table; each row once, with its cosine as ``score``.

    The metadata filter comes before anything else and goes down to the files.
    """
    one = spark.createDataFrame([([float(x) for x in query],)], "v array<double>").select(_unit("v").alias("__unit"))
    own = [int(h[0]) for h in index.model().transform(one).first()["__hashes"]]  # a number for each table
    rows = index.rows(spark)
    if where is not None:
        rows = rows.where(where)
    wanted = F.lit(False)
    for table, bucket in enumerate(own):
        near = list(range(bucket - probes, bucket + probes + 1))
        wanted = wanted | ((F.col("lsh_table") == table) & F.col("lsh_part").isin(*{b % FOLDERS for b in near}) & F.col("lsh_bucket").isin(*near))
    found = rows.where(wanted).drop("lsh_table", "lsh_part", "lsh_bucket").distinct()
    return found.withColumn("score", cosine(F.col(index.vector), F.array(*[F.lit(float(x)) for x in query])))


def indexed_search(spark: SparkSession, index: VectorIndex, query: list[float], k: int, *, where: Column | None = None, probes: int = 1, report: str = "report_id", page: str = "page", least: float = 0.0, overfetch: int = 4) -> DataFrame:
    """``semantic_search`` over the index: the ``k`` reports with the best chunk among the candidates, scores exact."""
    scored = candidates(spark, index, query, where=where, probes=probes).where(F.col("score") >= least)
    fetched = scored.orderBy(F.desc("score"), report, page).limit(overfetch * k)
    best = fetched.groupBy(report).agg(F.max("score").alias("best_score"), F.max_by(page, F.struct("score", (-F.col(page)).alias("p"))).alias("best_page"), F.count(F.lit(1)).alias("n_chunks"))
    return best.orderBy(F.desc("best_score"), report).limit(k)
