"""Labelled texts, to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, *, keep, rows: int | None = None) -> DataFrame:
    """(doc_id, text, label) of all labels that ``keep`` admits, or of about ``rows`` of them, picked by a hash of the id.

    ``rows`` is the documented bound of a sample, whose labels are broadcast. Labels other than 0 and 1 are passed over, of several
    labels of a document the largest counts, and of repeated documents the least text.
    """
    own = labels.where(keep & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("label"))
    if rows is None:
        docs = docs.where(keep)  # documents that learning leaves out need not move
    else:
        share = min(1.0, rows / max(1, own.count()))
        own = F.broadcast(own.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(label)), F.lit(1 << 31)) < int(share * (1 << 31))))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(own, "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").cast("int").alias("label"))
