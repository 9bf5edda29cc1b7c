"""Intermediate results: written once, read often, in the folder that all machines share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, the context's, and in local mode (tests) a temporary one.

    A cluster without either is an error, as no folder of one machine is read by the others.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="llm-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_started: dict[str, str] = {}


def _run_folder(spark: SparkSession) -> str:
    """A folder of this application below the shared one; it goes when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _started:
        folder = f"{shared_folder(spark).rstrip('/')}/staged-{app}"
        _started[app] = folder
        context = spark.sparkContext

        def remove() -> None:
            if context._jsc is not None:
                _delete(context, folder)

        atexit.register(remove)
    return _started[app]


_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def _delete(context, folder: str) -> None:
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str, over: DataFrame | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Later stages start from these files, so a lost executor costs the work since then and no more.
    The files stay until the application ends, or until a later result is staged ``over`` this one,
    which nothing may read any more then.
    """
    spark = df.sparkSession
    path = f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    result = spark.read.schema(df.schema).parquet(path)
    _paths[result] = path
    if over is not None:
        _delete(spark.sparkContext, _paths.pop(over))
    return result


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
