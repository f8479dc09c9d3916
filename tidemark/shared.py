"""A folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the session's checkpoint folder, which all executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        # Only a local session goes without one: executors would not see the driver's folder.
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows as a table of the shared folder: computed once, whoever reads them."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
