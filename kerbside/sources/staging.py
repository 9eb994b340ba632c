"""Tables that a query writes and reads again, in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A place for a dataset in the shared folder; in a local session without one, in a temporary folder."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/kerbside-{spark.sparkContext.applicationId}/{name}"
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{tempfile.mkdtemp(prefix='kerbside-')}/{name}"


def staged(df: DataFrame) -> DataFrame:
    """The same rows, computed once and written, for plans that read them several times."""
    path = scratch(df.sparkSession, f"staged-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
