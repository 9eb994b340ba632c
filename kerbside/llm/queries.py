"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import tokenize
from .chat_format import link_tool_calls
from .labelled import labelled_rows
from .language_id import fit_languages, identify
from .license_scan import containment_sql, scan_licenses
from .ngram_join import jaccard_components
from .preference_ranking import fit_ranking_rows, rank_quality
from .quality_rules import apply_quality_rules
from .source_divergence import audit_sources, divergence_sql
from .source_mixing import mix_sources
from .topk_search import top_k
from .spelling_variants import group_spellings, variant_sql
from .toxicity import fit_toxicity_rows, score_toxicity
from .warc import archive_sql, captures_of_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(modulus: int) -> Column:
    """crc32 of the document id as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(4) == 2
    model = fit_languages(docs.where(~held_out), public_tokenizers.path("piece_bpe_32k.model"), sample_docs=300)
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("copies")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table(spark, sf_dir, "embeddings").where(finite).select("vec_id", whole.alias("vec"))
    return top_k(rows, rows.where(F.col("vec_id") % 50 == 0))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_quality_rules(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return tokenize(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


#: Labelled documents that the quality ranking is fitted on, at most.
SAMPLE_ROWS = 6000


def _scored(scores: DataFrame, bar: float) -> DataFrame:
    return scores.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= bar).cast("int").alias("predicted"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity_rows(labelled_rows(docs, labels, "toxic", keep=remainder(3) != 1))
    return _scored(score_toxicity(docs, model), 0.7)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_tool_calls(table(spark, sf_dir, "conversations"))


def op10_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_ranking_rows(labelled_rows(docs, labels, "quality", rows=SAMPLE_ROWS, keep=remainder(3) != 1))
    return _scored(rank_quality(docs, model), 0.5)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures_of_pages(table(spark, sf_dir, "pages"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_language_id": op2_language_id,
    "op3_source_mixing": op3_source_mixing,
    "op4_topk_search": op4_topk_search,
    "op5_quality_rules": op5_quality_rules,
    "op6_ngram_join": op6_ngram_join,
    "op7_toxicity": op7_toxicity,
    "op8_chat_format": op8_chat_format,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_quality_ranking": op10_quality_ranking,
    "op11_warc": op11_warc,
    "op12_source_divergence": op12_source_divergence,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op1_license_scan": containment_sql(),
    "op11_warc": archive_sql(),
    "op12_source_divergence": divergence_sql(),
    "op13_spelling_variants": variant_sql(),
    "op3_source_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
        ), sums AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
        ), weighed AS (
            SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS cap FROM sums
        ), barred AS (
            SELECT *, cap / weight AS bar FROM weighed
        ), levels AS (
            SELECT *, row_number() OVER o AS place,
                (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
            FROM barred WINDOW o AS (ORDER BY bar, source NULLS LAST)
        ), fixed AS (
            SELECT place AS first_place, level AS fixed_level FROM levels WHERE level <= bar ORDER BY place LIMIT 1
        ), targets AS (
            SELECT source, source_size, CASE WHEN place >= first_place THEN fixed_level * weight ELSE cap END AS target FROM levels, fixed
        ), rated AS (
            SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
                ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS draw
            FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
        )
        SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM rated
    """,
    "op4_topk_search": """
        WITH vectors AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.vec, v.vec)::BIGINT AS score
            FROM vectors q JOIN vectors v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
