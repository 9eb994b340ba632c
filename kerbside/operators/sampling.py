"""Samples whose rows are picked by MD5 of a seed and their keys, so that every run, partitioning and engine picks the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequences import numbered, rank_strata

SEED = 20260903
#: Leading hexadecimal digits of a draw that make its span.
DIGITS = 3


def drawn(keys: list[str], seed: int = SEED) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *keys))


def drawn_sql(keys: str, seed: int = SEED) -> str:
    return f"md5(concat_ws('|', {seed}, {keys}))"


def shuffled(rows: DataFrame, keys: list[str], by: list[str] | None = None, first: int | None = None, seed: int = SEED) -> DataFrame:
    """Rows with their ``place`` from 0 in an order of their groups drawn by hash; with ``first``, at least the first so many."""
    placed = numbered(rows.withColumn("draw", drawn([*(by or [])[:1], *keys], seed)), F.substring("draw", 1, DIGITS), ["draw", *keys], by, first)
    return placed.drop("draw", "m")


def reservoir(rows: DataFrame, by: str, keys: list[str], size: int, seed: int = SEED) -> DataFrame:
    """At most ``size`` rows of each group, uniformly: those of the least draws. Only spans of draws that reach it are sorted."""
    return shuffled(rows, keys, [by], size, seed).where(F.col("place") < size).drop("place")


def stratified(rows: DataFrame, by: str, keys: list[str], score: str, size: int, strata: int, seed: int = SEED) -> DataFrame:
    """``size`` rows of each group over rank strata of a score, with their stratum.

    The remainder of the quota goes to the lower strata. What a stratum lacks is filled from the rest of the group, round robin
    over the strata. No group needs more than ``size`` rows of a stratum.
    """
    graded = rank_strata(rows, strata, [by], [score, *keys])
    picked = shuffled(graded, keys, [by, "stratum"], size, seed).where(F.col("place") < size)
    quota = F.lit(size // strata) + (F.col("stratum") < size % strata).cast("int")
    first = picked.withColumn("extra", F.greatest(F.col("place") + 1 - quota, F.lit(0)))
    order = Window.partitionBy(by).orderBy((F.col("extra") > 0).cast("int"), "extra", "stratum")
    return first.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= size).drop("place", "extra", "turn")
