"""The pipeline's stages and the registered queries of the operators."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from checks import compare
from danji.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.helpers import documents, prose

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    numbers = [int(n[2:].split("_")[0]) for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()
    assert set(ORACLE_SQL) <= set(QUERIES) and set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_agrees_with_sql(spark, name, monkeypatch):
    monkeypatch.setitem(compare.registry.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(compare.registry.ORACLE, name, ORACLE_SQL[name])
    message, _, rows = compare.compare(spark, compare.duckdb_tables(SF), name, SF)
    assert message == "" and rows > 0


@pytest.mark.parametrize("name", ["op1_mixing", "op2_surrogates", "op3_exact_dedup"])
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "Cross"):
        assert bad not in plan


def test_stages_pass_documents_on(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, given, SF).cache()
        if name != "packing":
            assert out.columns == docs.columns and 0 < out.count()
            if name != "mixing":
                assert out.join(given, docs.columns, "left_anti").count() == 0
            given = out
        else:
            ids = {r.doc_id for r in given.select("doc_id").distinct().collect()}
            assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == ids
            total = out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
            assert total <= 4096


def test_stages_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, prose(1, 40)), (3, prose(1, 40)), (4, prose(1, 40)), (None, "no id"), (5, prose(9, 9000), None, None)]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, rows), SF).count() > 0
        assert stage(spark, documents(spark, []), SF).count() == 0


def test_stages_judge_rows_of_null_and_repeated_ids(spark, monkeypatch):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(1, a), (5, a + " more"), (5, b), (None, "no id"), (7, b + " more"), (8, prose(3, 60))]
    left = corpus_pipeline.drop_near_copies(spark, documents(spark, rows), SF)
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(1, a), (5, b), (0, "no id"), (8, rows[5][1])])
    toxic = corpus_pipeline.toxicity

    def scored(docs, field, id_col="doc_id", with_text=False):
        return toxic(docs, field, id_col, with_text=with_text).withColumn("predicted", F.col("text").contains("birch").cast("int"))

    monkeypatch.setattr(corpus_pipeline, "toxicity", scored)
    rows = [(1, "fine"), (1, "birch"), (None, "birch"), (None, "good"), (3, "birch"), (4, None)]
    docs = documents(spark, rows)
    left = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert left.columns == docs.columns and sorted((r.doc_id or 0, r.text) for r in left.collect()) == [(0, "good"), (1, "fine"), (4, None)]


def test_the_mixture_takes_rows_not_ids(spark):
    rows = [(None, prose(i, 30 + 20 * i), "en", f"src{i % 2}") for i in range(4)] + [(1, prose(9, 50), "de", "src3"), (1, prose(8, 20), "en", "src1")]
    rows += [(3, "the same", "es", "src2")] * 3
    docs = documents(spark, rows)
    want = {}
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64(*docs.columns).alias("hash"))
    drawn = corpus_pipeline.mixture(
        docs.select(key.alias("doc_id"), "lang", "source", "text"), corpus_pipeline.mix_levels(), corpus_pipeline.MIX_WEIGHTS,
        corpus_pipeline.bytes_tokens(), fraction=corpus_pipeline.KEPT_TOKENS, max_epochs=corpus_pipeline.EPOCHS, seed=corpus_pipeline.MIX_SEED,
    )
    for r in drawn.collect():
        want[r.doc_id.hash] = want.get(r.doc_id.hash, 0) + r.epochs + (r.tail_tokens > 0)
    out = corpus_pipeline.mix(spark, docs, SF)
    got = {r.hash: r["count"] for r in out.groupBy(F.xxhash64(*out.columns).alias("hash")).count().collect()}
    assert out.columns == docs.columns and got == {h: n for h, n in want.items() if n} and len(set(want.values())) > 1
