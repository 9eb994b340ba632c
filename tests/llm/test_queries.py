"""The registered queries: contracts, SQL twins, and the pipeline against its stages by force."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kerbside.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op2_language_id": ["doc_id", "held_out", "lang_pred", "score"], "op3_source_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op4_topk_search": ["query_id", "rank", "vec_id", "score"], "op6_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op7_toxicity": ["doc_id", "held_out", "score", "predicted"], "op9_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_quality_ranking": ["doc_id", "held_out", "score", "predicted"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns[: len(COLUMNS[name])] == COLUMNS[name]
    if name != "op4_topk_search":
        assert df.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, sf_dir)
    made = con.sql(ORACLES[name])
    names = sorted(df.columns)
    assert sorted(made.columns) == names
    order = [made.columns.index(c) for c in names]
    nulls_last = lambda row: [(v is None, v) for v in row]
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=nulls_last) == sorted((tuple(r[i] for i in order) for r in made.fetchall()), key=nulls_last)


@pytest.mark.parametrize(("name", "label", "bar"), [("op7_toxicity", "toxic", 0.9), ("op10_quality_ranking", "quality", 0.9)])
def test_held_out_accuracy(spark, name, label, bar):
    # The smallest tables hold some thirty held-out labels, and as few to learn from.
    sf_dir = os.environ.get("TEST_LARGE_SF_DIR", "/root/testdata/sf0.1")
    if not os.path.isdir(sf_dir):
        pytest.skip("no larger tables here")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = QUERIES[name](spark, sf_dir).where("held_out").join(labels, "doc_id")
    assert found.agg(F.avg((F.col("predicted") == F.col(label)).cast("int")).alias("a")).first()["a"] >= bar


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    docs = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(10**9, None, None, None, None)], docs.schema))
    kept = {r["doc_id"] for r in QUERIES["op5_quality_rules"](spark, sf_dir).where("kept").collect()}
    quality = corpus_pipeline.quality_rules(spark, docs, sf_dir).cache()
    assert quality.columns == names and {r["doc_id"] for r in quality.collect()} == kept
    spoken = corpus_pipeline.language_id(spark, quality, sf_dir).cache()
    assert spoken.columns == names and spoken.count() == quality.count()
    single = corpus_pipeline.near_duplicates(spark, spoken, sf_dir).cache()
    found = QUERIES["op6_ngram_join"](spark, sf_dir).where(F.col("doc_id").isin(*kept))
    assert single.columns == names and single.count() == single.select("doc_id").distinct().count() <= found.count()
    mixed = corpus_pipeline.source_mixing(spark, single, sf_dir).cache()
    assert mixed.columns == names
    assert corpus_pipeline.tokenisation(spark, mixed, sf_dir).count() == mixed.count()


def test_pipeline_shape():
    assert [k for k, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
