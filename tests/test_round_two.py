"""Nothing is lost over restarts, NULL groups, batches of mixed widths, or many rows for each cell."""

import random

from pyspark.sql import functions as F

from vecloom.functions.registry import register_vector_functions
from vecloom.functions.vectors import array_distance
from vecloom.operators.cells import append_cells, build_cells, fit_centroids, topk_cells
from vecloom.operators.hashing import embed_hash
from vecloom.operators.pooling import mean_pool_groups
from vecloom.operators.topk import topk_batch
from vecloom.plans.retrieval import ask
from vecloom.sources.requests import parse_requests
from vecloom.streaming.embed_stream import answer_requests, embed_stream, reject_stream, request_stream, write_stream


def test_stream_goes_on_where_it_ended(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")

    def run(ids):
        spark.createDataFrame([(i, f"text {i}") for i in ids], "id long, text string").write.mode("append").json(source)
        stream = spark.readStream.schema("id long, text string").json(source)
        write_stream(embed_stream(stream, "text", lambda d, t, o: embed_hash(d, t, o, 16)), sink).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(sink).collect())

    assert run([1, 2]) == [1, 2]
    assert run([3, 4]) == [1, 2, 3, 4]


def test_every_request_is_valid_or_rejected(spark, tmp_path):
    source = tmp_path / "requests"
    source.mkdir()
    (source / "a.json").write_text('{"text": "a"}\n{"broken\n{"no": "text"}\n')

    def rows(stream, name):
        write_stream(stream, str(tmp_path / name)).awaitTermination()
        return spark.read.parquet(str(tmp_path / name)).collect()

    assert [r.text for r in rows(request_stream(spark, str(source)), "good")] == ["a"]
    assert sorted(r.value for r in rows(reject_stream(spark, str(source)), "bad")) == ['{"broken', '{"no": "text"}']


def test_sql_functions_do_not_depend_on_batches(spark):
    register_vector_functions(spark)
    rows = [(1, [0.0, 3.0], [4.0, 0.0]), (2, [1.0, 2.0, 2.0], [0.0, 0.0, 0.0]), (3, None, [1.0]), (4, [], [])]
    table = spark.createDataFrame(rows, "id long, a array<double>, b array<double>")
    for parts in (1, 2):
        got = table.coalesce(1).repartition(parts).selectExpr("id", "array_distance(a, b) AS d", "l2_normalize(a) AS u")
        found = {r.id: (r.d, None if r.u is None else [round(x, 5) for x in r.u]) for r in got.collect()}
        assert found == {
            1: (5.0, [0.0, 1.0]), 2: (3.0, [0.33333, 0.66667, 0.66667]), 3: (None, None), 4: (0.0, []),
        }
    plain = {r.id: r.d for r in table.select("id", array_distance("a", "b").alias("d")).where("id < 4").collect()}
    assert plain == {1: 5.0, 2: 3.0, 3: None}


def test_pooling_keeps_keys_without_vectors_and_shuffles_once_a_level(spark):
    rows = [(1, [1.0, 3.0]), (1, None), (1, [3.0, 5.0]), (2, None), (2, None), (None, [2.0, 2.0])]
    pooled = mean_pool_groups(spark.createDataFrame(rows, "k long, v array<float>").repartition(3), "k", "v")
    assert {r.k: r.embedding for r in pooled.collect()} == {1: [2.0, 4.0], 2: None, None: [2.0, 2.0]}
    plan = mean_pool_groups(spark.createDataFrame(rows, "k long, v array<float>"), "k", "v")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(k#") == 2  # by key and salt, then by key


def test_centroids_are_fitted_on_all_rows(spark):
    rng = random.Random(1)
    rows = [([rng.random(), rng.random()],) for _ in range(2500)]
    table = spark.createDataFrame(rows, "v array<double>").coalesce(1)
    plain = fit_centroids(table, "v", 2).orderBy("cell").collect()
    assert plain == fit_centroids(table, "v", 2, rows_per_cell=None).orderBy("cell").collect()
    assert plain != fit_centroids(table, "v", 2, rows_per_cell=100).orderBy("cell").select(F.col("cell"), "centroid").collect()


def _vectors(spark, n, seed=3):
    rng = random.Random(seed)
    return spark.createDataFrame([(f"{i:04d}", [rng.random(), rng.random()]) for i in range(n)], "id string, v array<double>")


def test_questions_with_long_keys_are_cut_into_blocks_by_their_bytes(spark):
    rows = _vectors(spark, 60)
    asked = rows.select(F.concat("id", F.lit("x" * 4000)).alias("qid"), F.col("v").alias("q"))
    plain = topk_batch(rows, asked, 3, "id", "v", "qid", "q").collect()
    cut = topk_batch(rows, asked, 3, "id", "v", "qid", "q", max_question_bytes=50_000).collect()
    assert sorted(plain) == sorted(cut) and len(plain) == 180


def test_rows_added_to_cells_are_found(spark, tmp_path):
    rows = _vectors(spark, 80)
    centroids = spark.createDataFrame([(0, [0.2, 0.2]), (1, [0.8, 0.8])], "cell int, centroid array<double>")
    index = build_cells(rows.where("id < '0040'"), "id", "v", str(tmp_path / "cells"), centroids)
    append_cells(rows.where("id >= '0040'").withColumn("extra", F.lit(1)), index)
    asked = rows.select(F.col("id").alias("qid"), F.col("v").alias("q"))
    found = topk_cells(spark, index, asked, 2, 3, "qid", "q").collect()
    assert sorted(found) == sorted(topk_batch(rows, asked, 3, "id", "v", "qid", "q").collect())
    encode = lambda df, text, out: df.withColumn(out, F.array(F.lit(0.1), F.lit(0.9)))
    near = [r.id for r in ask(rows, "?", encode, 4, "id", "v").collect()]
    assert near == [r.id for r in ask(rows, "?", encode, 4, "id", "v", index=index, nprobe=2).collect()]


def test_every_request_is_answered_once(spark):
    lines = [
        '{"id": "a", "text": "one", "model": "m"}', '{"id": "b", "text": "two", "model": "n"}', '{"id": "c", "text": "x"}',
        '{"id": "d", "model": "m"}', "{", '{"id": "f", "text": "", "model": "m"}',
    ]
    table = spark.createDataFrame([(x,) for x in lines], "value string")
    encode = lambda df, text, out: embed_hash(df, text, out, 16)
    got = answer_requests(parse_requests(table, "value", "id"), encode, ["m"]).collect()
    assert {(r.id, r.status, r.response is not None) for r in got} == {
        ("a", "answered", True), ("b", "unknown_model", False), ("c", "unknown_model", False),
        ("d", "missing_text", False), (None, "malformed_json", False), ("f", "answered", True),
    }
    assert len(got) == len(lines)
