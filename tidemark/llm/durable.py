"""Intermediate tables that outlive executors.

Multi-pass operators write what a later pass needs into the folder that the cluster names in
``spark.checkpoint.dir`` and read it back, so lineage is cut and no pass runs twice.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder. Only a local session without the setting gets a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        _OWN[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _OWN[app]


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the table as read from there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
