"""Results that several branches of a report read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def staged(df: DataFrame, folder: str | None) -> DataFrame:
    """``df``, written to Parquet below ``folder`` and read from there; without a folder ``df`` itself.

    The folder is the caller's (``Catalog(workdir=...)``), shared by all executors, and so is the
    choice between one more write and one more run of the plan. With a folder this runs a job.
    """
    if folder is None:
        return df
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
