"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "pagewell", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on. Partition counts are left to the
    cluster's own settings unless passed in ``conf`` (dots written as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_FOLDERS: dict[str, list[str]] = {}


def work_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared folder the cluster names.

    Only a local session without that setting gets a temporary folder, one for
    the session; on a cluster such a folder would not be visible to the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.pagewell.scratch", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="pagewell-")
        spark.conf.set("spark.pagewell.scratch", root)
    folder = os.path.join(root, f"{name}-{uuid.uuid4().hex}")
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def release_work(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far by this session, and return
    how many folders there were. DataFrames that read them can't be used any more."""
    folders = _FOLDERS.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(folders)


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, from a table written to the shared folder: computed
    once, and not again when an executor is lost."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
