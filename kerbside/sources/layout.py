"""Tables kept in buckets by track, so that what joins or windows them by track reads its partitions without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .staging import scratch


def by_track_session(spark: SparkSession) -> SparkSession:
    """A session of its own over the same catalog, in which joins by track and frame are satisfied with partitions by track.

    Spark asks for partitions by all keys of a join unless it is told that some will do; the caller's session is left as it is.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    return own


def bucketed(df: DataFrame, key: str, order: list[str], buckets: int, name: str | None = None, reader: SparkSession | None = None) -> DataFrame:
    """The same rows as a table of ``buckets`` buckets by ``key``, sorted within by the key and ``order``; tables of one number of buckets go together.

    Rows are dealt by the key before they are written, so that a bucket is one file. ``name`` is kept by the session's catalog, and lies in the
    folder that all executors share. A bucket holds a key whole: their number should make a bucket fit a task. With ``reader``, the table is that
    session's.
    """
    name = name or f"kerbside_{uuid.uuid4().hex}"
    spark = df.sparkSession
    writer = df.repartition(buckets, key).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key, *order)
    writer.option("path", scratch(spark, name)).saveAsTable(name)
    return (reader or spark).table(name)
