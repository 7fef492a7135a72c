"""Cutting lineage through the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: dict[str, tuple[SparkSession, str]] = {}


def folder(spark: SparkSession) -> str:
    """This application's own folder below ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; on a cluster
    the setting is required.  The folder is removed when the driver's Python ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
        if not shared and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _FOLDERS[app] = (spark, f"{(shared or tempfile.mkdtemp(prefix='docloom-')).rstrip('/')}/docloom-{app}-{uuid.uuid4().hex[:8]}")
    return _FOLDERS[app][1]


def kept(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder as a compressed table, so that later steps do not run them again.

    All executors can read it, so losing one loses nothing; later steps read the
    columns they need only, and know its size.
    """
    path = f"{folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _clear() -> None:
    for spark, path in _FOLDERS.values():
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:
            pass  # the session has ended already; whoever owns the folder clears it
