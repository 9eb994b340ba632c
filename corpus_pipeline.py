"""A corpus pipeline: quality rules, language ID, near-duplicate removal, source mixing, tokenisation.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and reads it again as the next
stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.byte_bpe import tokenize
from kerbside.llm.durable import shared_folder
from kerbside.llm.language_id import UNDETERMINED, fit_languages, identify
from kerbside.llm.ngram_join import jaccard_components
from kerbside.llm.quality_rules import apply_quality_rules
from kerbside.llm.source_mixing import emit_copies

#: Posterior probability of the predicted language below which a document goes.
LEAST_CONFIDENCE = 0.5
#: Nats a letter below what is usual in the predicted language from which a document goes. Prose of ten words and more lies up to
#: 3 below on sf0.1, letters drawn at random 5.8 and more.
MOST_ODD = 4.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return apply_quality_rules(docs, carry=True).where("kept").select("row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined and explains their letters; learnt from the languages that the documents state."""
    model = fit_languages(docs, public_tokenizers.path("piece_bpe_32k.model"), sample_docs=300)
    found = identify(docs, model, carry=True)
    sure = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_CONFIDENCE) & (F.col("oddness") <= MOST_ODD)
    return found.where(sure).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of documents that 80 % of shared five-word shingles connect.

    Where ids are null or shared by several rows, each different (id, text) is a document of its own under a key made of both;
    else ids are keys, and the smallest stays.
    """
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id is null or n > 1").limit(1).count()
    if not odd:
        stays = jaccard_components(docs).where("doc_id = component_id").select(F.col("doc_id").alias("stays"))
        return docs.join(stays, docs["doc_id"] == stays["stays"], "left_semi")
    # A 64-bit hash of id and text: equal rows agree, others meet with a chance of 2**-64 a pair.
    row = F.struct(*(docs[c] for c in docs.columns))
    key = F.xxhash64(F.coalesce(docs["doc_id"].cast("string"), F.lit("null")), F.coalesce(F.concat(F.lit("t"), docs["text"]), F.lit("null")))
    whole = F.to_json(row, {"ignoreNullFields": "false"})
    rows = docs.select(key.alias("key"), row.alias("row"), whole.alias("whole"))
    # Of rows of one id and text the first by all columns stays, under a total order.
    rows = rows.groupBy("key").agg(F.min_by("row", "whole").alias("row"))
    found = jaccard_components(rows.select("key", F.col("row.text").alias("text")), "key")
    named = rows.join(found.select(F.col("doc_id").alias("key"), "component_id"), "key")
    place = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), "key")
    return named.groupBy("component_id").agg(F.min_by("row", place).alias("row")).select("row.*")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return emit_copies(docs)


def tokenisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of every document of the mix."""
    return tokenize(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", source_mixing),
    ("byte-level BPE", tokenisation),
]

#: Zstandard ratios, language models and rank files are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; what passes between them is written to the shared checkpoint folder."""
    shared = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name = uuid.uuid4().hex
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = f"{shared}/pipeline-{name}/{k}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
