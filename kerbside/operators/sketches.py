"""Mergeable sketches as columns: distinct counts and quantiles by time bin, merged over any bins without the rows.

Distinct counts are HyperLogLog sketches. Quantiles are counts by logarithmic buckets (Masson et al., 2019), held as a map: a bucket's value
is within ``ERROR`` of all values in it, and merging adds counts, so that a merged sketch is the sketch of the whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest relative error of a quantile, and the logarithm of a bucket's width that follows.
ERROR = 0.01
WIDTH = math.log((1 + ERROR) / (1 - ERROR))
#: Key of the bucket of the number 1; smaller positive numbers have keys above 0 down to 1e-300, negative numbers negative keys, 0 has 0.
ONE = 40_000
#: Registers of a distinct sketch, as a power of two: the standard error is 1.04 / sqrt(2 ** REGISTERS).
REGISTERS = 12


def bucket(value: Column) -> Column:
    """Key of a number's bucket, in order of the numbers."""
    size = F.greatest(F.abs(value), F.lit(1e-300))
    key = (F.ceil(F.log(size) / WIDTH) + ONE).cast("int")
    return F.when(value > 0, key).when(value < 0, -key).when(value == 0, 0)


def of_bucket(key: Column) -> Column:
    """The number that stands for a bucket."""
    size = F.exp((F.abs(key) - ONE) * WIDTH) * 2 / (1 + math.exp(WIDTH))
    return F.when(key == 0, 0.0).otherwise(F.signum(key.cast("double")) * size)


def sketched(rows: DataFrame, by: list[str], item: str, value: str) -> DataFrame:
    """(by, n, distinct_items, quantiles): one row a group, with its number of rows and both sketches; null values and items do not count.

    Rows are counted by group and bucket first, so that what meets in a group is a row a bucket. A group without values has an empty map.
    """
    counts = rows.groupBy(*by, bucket(F.col(value)).alias("key")).agg(F.count("*").alias("rows"), F.hll_sketch_agg(item, REGISTERS).alias("part"))
    entry = F.when(F.col("key").isNotNull(), F.struct("key", F.col("rows").alias("value")))
    held = F.map_from_entries(F.array_sort(F.collect_list(entry)))
    return counts.groupBy(*by).agg(F.sum("rows").alias("n"), F.hll_union_agg("part").alias("distinct_items"), held.alias("quantiles"))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of (n, distinct_items, quantiles) rows put together by fewer columns."""
    buckets = sketches.select(*by, F.explode("quantiles").alias("key", "value")).groupBy(*by, "key").agg(F.sum("value").alias("value"))
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("quantiles")
    values = buckets.groupBy(*by).agg(entries) if by else buckets.agg(entries)
    counts = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("distinct_items").alias("distinct_items"))
    if not by:
        return counts.crossJoin(F.broadcast(values))
    both = [counts[c].eqNullSafe(values[c]) for c in by]
    none = F.create_map().cast(values.schema["quantiles"].dataType)
    joined = counts.join(values, both, "left")
    return joined.select(*(counts[c] for c in by), "n", "distinct_items", F.coalesce("quantiles", none).alias("quantiles"))


def distinct_estimate(sketch: str) -> Column:
    """About how many items a distinct sketch has seen."""
    return F.hll_sketch_estimate(sketch)


def quantile_estimate(quantiles: str, q: float) -> Column:
    """The value at place floor(q (n - 1)) of a quantile sketch, to within ERROR; null without values."""
    entries = F.array_sort(F.map_entries(quantiles))
    n = F.aggregate(entries, F.lit(0).cast("long"), lambda total, e: total + e["value"])
    place = F.floor(F.lit(float(q)) * (n - 1))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("key"))

    def step(state: Column, e: Column) -> Column:
        seen = state["seen"] + e["value"]
        return F.struct(seen.alias("seen"), F.when(state["key"].isNull() & (seen > place), e["key"]).otherwise(state["key"]).alias("key"))

    return of_bucket(F.aggregate(entries, start, step, lambda state: state["key"]))
