"""Distances in SQL without Python, rows without texts, routing by value, and a fixed vocabulary."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from vecloom.functions.registry import register_vector_functions
from vecloom.functions.vectors import array_distance
from vecloom.operators.hashing import embed_hash
from vecloom.streaming.embed_stream import route_encoders

SF = "/root/testdata/sf0.001"


def test_vector_distance_needs_no_python(spark):
    register_vector_functions(spark)
    rows = [(1, [0.0, 3.0], [4.0, 0.0]), (2, None, [1.0]), (3, [], []), (4, [float("nan")], [0.0])]
    table = spark.createDataFrame(rows, "id long, a array<float>, b array<float>")
    got = table.selectExpr("id", "vector_distance(a, b) AS d")
    assert str(got.orderBy("id").collect()) == str(table.select("id", array_distance("a", "b").alias("d")).orderBy("id").collect())
    plan = contract.p5_question_parameter(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Arrow" not in plan and "Python" not in plan
    for bad in ("array(1D), array(1D, 2D)", "array(CAST(NULL AS double)), array(1D)"):
        with pytest.raises(Exception, match="vector_distance"):
            spark.sql(f"SELECT vector_distance({bad})").collect()


def test_rows_without_texts_are_not_lost(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "some words", "en", "a", 1), (2, None, "en", "a", 0), (3, "", "en", "a", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = {}
    for r in contract.s4_vector_table(spark, str(tmp_path)).collect():
        found.setdefault(r.doc_id, []).append((r.width, r.bucket))
    assert found[2] == [(None, None)] and found[3] == [(384, None)] and len(found[1]) == 2


def test_each_request_goes_to_its_encoder(spark):
    rows = [(i, f"text {i}", m) for i, m in enumerate(["a", "b", None, "c", "a"])]
    requests = spark.createDataFrame(rows, "id long, text string, model string")
    encoders = {
        "a": lambda df, text, out: embed_hash(df, text, out, 8),
        "b": lambda df, text, out: embed_hash(df, text, out, 32),
    }
    got = {r.id: list(r.embedding) for r in route_encoders(requests, encoders).collect()}
    for name, dim in (("a", 8), ("b", 32)):
        own = embed_hash(requests.where(F.col("model") == name), "text", "v", dim).collect()
        assert len(own) == (2 if name == "a" else 1) and all(str(got[r.id]) == str(list(r.v)) for r in own)
    assert sorted(got) == [0, 1, 4]


def test_vocabulary_does_not_come_from_the_data():
    words = contract._vocabulary()
    assert len(words) == len(set(words)) > 20_000 and {"the", "what", "book"} <= set(words)
