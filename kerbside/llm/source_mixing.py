"""Mix the sources of a corpus to target weights, with DataFrame operations only.

Words are summed by source; each source's target divided by its words is its repetition rate. A document is emitted
floor(rate) times, and once more if a draw from a hash of its id falls below the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import durable

WORD = r"[^\x20\x09-\x0D]+"
#: Sources beyond this many are joined by a shuffle instead of a broadcast.
BROADCAST_SOURCES = 100_000


def words_in(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """source, source_size and target of each source, from (source, size) rows.

    Sources by code point, null last, take ``weights`` in turn and divide ``share`` times all words by weight; none takes more
    than ``most`` times its own, and what it leaves goes to the others by weight. With sources ordered by ``most`` x words over
    weight, the capped ones come first, so that one running sum finds the level at which all others are filled.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    names = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(names) - 1, F.lit(len(weights))) + 1).cast("int"))
    order = Window.orderBy("bar", F.col("source").asc_nulls_last())
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    capped, passed = (F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("cap", "weight"))
    level = (F.sum("source_size").over(all_rows) * F.lit(float(share)) - capped) / (F.sum("weight").over(all_rows) - passed)
    ranked = (
        by_source.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("bar", F.col("cap") / F.col("weight"))
        .select("*", F.row_number().over(order).alias("place"), level.alias("level"))
    )
    # The first source whose bar the level does not pass gives the level of all from there on; those before are capped.
    fixed = F.min(F.when(F.col("level") <= F.col("bar"), F.struct("place", "level"))).over(all_rows)
    target = F.when(F.col("place") >= F.col("fixed.place"), F.col("fixed.level") * F.col("weight")).otherwise(F.col("cap"))
    return ranked.withColumn("fixed", fixed).select("source", "source_size", target.alias("target"))


def draw(key: Column) -> Column:
    """A number in [0, 1) from the MD5 of the key, the same in every run."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
    weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, carry: bool = False,
) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken of every document, and with ``carry`` its whole row as ``row``.

    A null text has 0 words; null is a source of its own, the last. A source without words has target 0 and its documents no
    copies. Repeated rows of an id are drawn alike. ``copies`` never passes the rate rounded up, so no document exceeds ``most``
    times its size. One row a source and task leaves the aggregation; the sums, one row a source, meet in one task, where
    sources are ranked. They are broadcast up to BROADCAST_SOURCES of them, and joined by a shuffle that splits hot sources
    beyond.
    """
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("own_source"), words_in(F.col(text_col)).alias("size"),
        *([F.struct(*(docs[c] for c in docs.columns)).alias("row")] if carry else []),
    )
    targets = durable(source_targets(sized.select(F.col("own_source").alias("source"), "size"), weights, share, most))
    side = F.broadcast(targets) if targets.count() <= BROADCAST_SOURCES else targets
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (draw(F.col("doc_id")) < rate - F.floor(rate)).cast("int")
    mixed = sized.join(side, F.col("own_source").eqNullSafe(F.col("source"))).withColumn("copies", F.coalesce(copies, F.lit(0)))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", F.col("copies").cast("int"), taken, *(["row"] if carry else []))


def emit_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, with the columns of ``docs``."""
    mixed = mix_sources(docs, carry=True, **options)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")
