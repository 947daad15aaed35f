"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import cache
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Every stored instant is UTC, so day, week and hour boundaries must be UTC too.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Payload files go to Python whole; batches are bounded by bytes, not by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    # A finished query's shuffle files are of no more use; else they stay until the driver's
    # garbage collector happens to run. Where a frame runs again, its shuffles are written again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session.

    Also hands this package to the executors, whose Python workers import it by name.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    archive = _archive(spark.sparkContext.applicationId)
    if archive not in _sent:
        _sent.add(archive)
        spark.sparkContext.addPyFile(archive)
    return spark


_sent: set[str] = set()


@cache
def _archive(application: str) -> str:
    """A zip of this package, which Spark serves from the driver like any ``--py-files``."""
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix=f"{application}-"), "stridelake_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(here)))
    return path


@cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"stridelake-{application}-")


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session without that setting falls back to a fresh temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_dir(context.applicationId)
    return f"{root.rstrip('/')}/stridelake-{context.applicationId}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove everything this application wrote to the shared folder, at the end of its work."""
    _delete(spark, shared_dir(spark))


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage for results that several outputs need; the files outlive lost executors.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _stored[stored] = path
    return stored


_stored: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*frames: DataFrame) -> None:
    """Remove the files of materialised frames.

    Only for frames that nothing reads any more but what has been written itself.
    """
    for df in frames:
        _delete(df.sparkSession, _stored.pop(df))
