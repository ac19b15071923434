"""Making the package importable on executors, and the folder that they share with the driver."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder that ``spark.checkpoint.dir`` names. Only a local session without it gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        _OWN[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _OWN[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for landed files and intermediate tables of this application."""
    return f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, unless PYTHONPATH names it for them already."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(_ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _SHIPPED.add(app)
    archive = Path(tempfile.mkdtemp()) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in (_ROOT / "tidemark").rglob("*.py"):
            out.write(path, path.relative_to(_ROOT))
    spark.sparkContext.addPyFile(str(archive))
