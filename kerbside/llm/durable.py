"""Cut a plan's lineage in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

#: Makes Spark drop a finished query's shuffle files at once.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="shared-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.

    Where it is unset a local session, as in tests, gets a temporary one; a cluster's executors could not reach that, so there it
    is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _local_folder()


def durable(df: DataFrame) -> DataFrame:
    """The same rows, computed now and written as a table to the shared folder, so that a lost executor costs no recomputation.

    The shuffle files behind them go once they are written. The tables stay until the folder's owner clears it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_DROP_SHUFFLES)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
