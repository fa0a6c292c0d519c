"""The registered queries, and the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tests.llm.samples import docs, near_copies
from tests.llm.test_similar import brute
from tests.oracle import connect, difference
from vidstrata.llm import queries
from vidstrata.llm.common import held_out

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert set(queries.SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SF), SF, queries.QUERIES[name], queries.SQL[name]) is None


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.SQL])
def test_query_covers_its_table(spark, name):
    found = queries.QUERIES[name](spark, SF)
    key, table = {"op1": ("page_id", "pages"), "op13": ("vec_id", "embeddings")}.get(name.split("_")[0], ("doc_id", "documents"))
    ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in found.select(key).collect()} == ids


def test_pipeline_stages(spark, tmp_path):
    given = docs(spark, near_copies(bases=6) + ["12 34", "the end"]).select("doc_id", "text", "lang", "source", "n_chars", F.lit(1).alias("extra"))
    given = given.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("fr"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, given, SF).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "packing":
            assert after.columns == given.columns
        seen[name] = (given.collect(), after.collect())
        given = after
    before, after = seen["language"]
    lettered = {r.doc_id for r in before if r.text and any(c.isalpha() for c in r.text)}
    assert {r.doc_id for r in after} == lettered
    before, after = seen["similar"]
    order = sorted(before, key=lambda r: r.doc_id)
    found = brute([r.text for r in order])
    assert {r.doc_id for r in after} == {order[i].doc_id for i, (n, c) in found.items() if i == c}
    before, after = seen["repeats"]
    assert {r.doc_id for r in before} == {r.doc_id for r in after}
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = seen["mixing"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    before, after = seen["packing"]
    assert sum(r.length == r.doc_tokens for r in after) <= len(before)
    assert {r.doc_id for r in after} == {r.doc_id for r in before}


def test_language_stage_goes_by_the_prediction(spark, monkeypatch):
    from vidstrata.llm import language

    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("__language", F.lit(1)).withColumn("language", F.lit(2))
    everything = corpus_pipeline.known_language(spark, rows, SF)
    assert everything.columns == rows.columns
    assert everything.count() > 0.99 * rows.where("text RLIKE '[a-zA-Z]'").count()
    monkeypatch.setattr(corpus_pipeline, "WANTED", ("en", "de"))
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, rows, SF).collect()}
    model = language.fit(rows.where(~held_out(F.col("doc_id"))))
    found = language.detect(rows.select("doc_id", "text"), model).select("doc_id", "language.*").collect()
    assert kept == {r.doc_id for r in found if r.lang_pred in ("en", "de") and r.score >= 0.5}
    assert 0 < len(kept) < rows.count()
    # a model that errs changes the rows
    for wanted, name, score, n in ((("en", "de"), "fr", 1.0, 0), (None, "fr", 1.0, rows.count()), (None, "fr", 0.4, 0), (None, "und", 1.0, 0)):
        monkeypatch.setattr(corpus_pipeline, "WANTED", wanted)
        guess = F.struct(F.lit(name).alias("lang_pred"), F.lit(score).alias("score"))
        monkeypatch.setattr(language, "detect", lambda docs, model, into, guess=guess: docs.withColumn(into, guess))
        assert corpus_pipeline.known_language(spark, rows, SF).count() == n


def test_stages_keep_columns_of_any_name(spark):
    names = ["__hash", "__id", "__digest", "__of", "__size", "__chance", "__copy"]
    given = docs(spark, near_copies(bases=3)).select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[1:4]:
        after = stage(spark, given, SF)
        assert after.columns == given.columns, name
        assert {tuple(r[n] for n in names) for r in after.collect()} == {tuple(range(len(names)))}, name


def test_pipeline_of_no_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
