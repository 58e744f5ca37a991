"""Searches in pieces, salted cells, and the levels of pooled sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_search import DIM, brute, cell_index, frame, make, plain

from vecloom.functions.vectors import DISTANCE_DIGITS
from vecloom.operators import cells as cells_module
from vecloom.operators.cells import _Centers, _nearest, topk_cells, with_cells
from vecloom.operators.pooling import mean_pool_groups
from vecloom.operators.topk import topk_batch


@pytest.mark.parametrize("most", [900, 4000, 20_000])
def test_pieces_equal_brute_force(spark, most):
    corpus, questions = make(200, 31), make(150, 32)
    found = topk_batch(frame(spark, corpus), frame(spark, questions, "qid"), 5, max_question_bytes=most)
    assert plain(found.collect()) == sorted(brute(corpus, questions, 5))


def test_pieces_scan_the_corpus_once(spark, tmp_path):
    frame(spark, make(300, 33)).write.parquet(str(tmp_path / "corpus"))
    corpus = spark.read.parquet(str(tmp_path / "corpus"))
    asked = frame(spark, make(100, 34), "qid").withColumn("embedding", F.col("embedding").cast("array<float>"))
    found = topk_batch(corpus, asked, 5, max_question_bytes=2000)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [id") == 1 and "Join" not in plan
    assert found.count() == 500


def test_pieces_of_one_hot_vector(spark):
    """Half of all rows and questions are one vector."""
    corpus = [(i, [0.5] * DIM) if i % 2 else (i, [float(i)] * DIM) for i in range(400)]
    found = topk_batch(frame(spark, corpus), frame(spark, corpus, "qid"), 3, max_question_bytes=3000)
    assert plain(found.collect()) == sorted(brute(corpus, corpus, 3))


@pytest.mark.parametrize("piece_bytes", [1 << 26, 3000])
def test_joined_cells_equal_scanned_cells(spark, monkeypatch, piece_bytes):
    """Two thirds of all rows lie in one cell, which is then salted over several pieces."""
    monkeypatch.setattr(cells_module, "PIECE_BYTES", piece_bytes)
    rng = np.random.default_rng(35)
    corpus = [(i, [float(x) for x in rng.standard_normal(DIM) * (0.01 if i % 3 else 5)]) for i in range(600)]
    index, asked = cell_index(spark, corpus, 6), frame(spark, corpus[:80], "qid")
    sizes = [r["count"] for r in index.rows(spark).groupBy("cell").count().collect()]
    assert max(sizes) >= 400
    for nprobe in (1, 3, 6):
        scanned = topk_cells(spark, index, asked, nprobe, 5).collect()
        joined = topk_cells(spark, index, asked, nprobe, 5, max_question_bytes=2000)
        assert plain(joined.collect()) == plain(scanned)
    if piece_bytes == 3000:
        # No piece holds more rows than fit: 112 bytes each, questions aside.
        met = []
        monkeypatch.setattr(cells_module, "meet", lambda q, r, n, k: met.append((q, r)) or cells_module_meet(q, r, n, k))
        topk_cells(spark, index, asked, 6, 5, max_question_bytes=2000).collect()
        questions, rows = met[0]
        assert rows.groupBy("piece").count().agg(F.max("count")).first()[0] <= 2 * (3000 // 112)
        assert questions.groupBy("piece").count().agg(F.max("count")).first()[0] <= 2 * (2000 // 112)


cells_module_meet = cells_module.meet


def test_joined_cells_without_questions_or_vectors(spark):
    index = cell_index(spark, make(60, 36, odd=False), 3)
    nothing = [(1, None), (2, [float("nan")] * DIM)]
    assert topk_cells(spark, index, frame(spark, nothing, "qid"), 2, 5, max_question_bytes=0).collect() == []
    assert topk_cells(spark, index, frame(spark, [], "qid"), 2, 5, max_question_bytes=0).collect() == []


def test_nearest_centers_equal_a_full_sort():
    rng = np.random.default_rng(37)
    for scale in (1.0, 1e4):
        centers = np.round(rng.standard_normal((200, 8)), 1) * scale
        centers[50:60] = centers[40:50]  # ties
        matrix = np.r_[centers[::3], rng.standard_normal((300, 8)) * scale].astype(np.float32)
        exact = np.sqrt(((matrix[:, None].astype(float) - centers[None]) ** 2).sum(axis=2))
        for take in (1, 5, 200):
            expected = np.argsort(np.round(exact, DISTANCE_DIGITS), axis=1, kind="stable")[:, :take]
            assert (_nearest(matrix, centers, take) == expected).all()


@pytest.mark.parametrize("spread", [0.05, 1.0, 1e25])
def test_two_level_centers_equal_one_level(spread):
    """Clusters far apart, no clusters, and norms beyond single precision; ties, copies, groups under `take`."""
    rng = np.random.default_rng(38)
    heads = rng.standard_normal((30, 8)) * 5
    centers = np.round(heads[rng.integers(0, 30, 900)] + rng.standard_normal((900, 8)) * spread, 2)
    centers[100:160] = centers[40:100]
    matrix = np.r_[centers[::7], heads, rng.standard_normal((200, 8)) * 5]
    grouped = _Centers(centers, least=10)
    assert len(grouped.members) > 5
    for take in (1, 4, 60, 900):
        assert (grouped.nearest(matrix, take) == _nearest(matrix, centers, take)).all()
        assert grouped.nearest(matrix[:0], take).shape == (0, take)
    single = matrix.astype(np.float32)
    assert (grouped.nearest(single, 3) == _nearest(single, centers, 3)).all()


def test_equal_centers_have_one_group():
    centers = np.ones((50, 4))
    assert (_Centers(centers, least=10).nearest(np.zeros((5, 4)), 3) == [0, 1, 2]).all()


def test_centroids_beyond_a_broadcast_give_the_same_cells(spark, monkeypatch):
    rows = frame(spark, make(200, 39) + [(7, [0.25] * DIM), (300, [float("inf")] * DIM)])  # a repeated key
    centroids = frame(spark, make(40, 40, odd=False)).select(F.col("id").cast("int").alias("cell"), F.col("embedding").alias("centroid"))

    def found(n):
        placed = with_cells(rows.withColumn("cell", F.lit("own")), "embedding", "near", centroids, n)
        return sorted(map(str, placed.collect()))

    expected = {n: found(n) for n in (1, 3, 2**31 - 1)}
    index = cell_index(spark, make(60, 41, odd=False), 3)
    asked = frame(spark, make(10, 42), "qid")
    hits = plain(topk_cells(spark, index, asked, 2, 5).collect())
    monkeypatch.setattr(cells_module, "CENTROID_BYTES", 0)
    for n, cells in expected.items():
        assert found(n) == cells
    assert plain(topk_cells(spark, index, asked, 2, 5).collect()) == hits
    with pytest.raises(ValueError, match="with_cells"):
        cells_module.nearest_cells(spark, centroids)


def test_pooled_sums_of_many_tasks_stay_small(spark):
    """One key in 3,000 tasks: neither level gathers more than some arrays."""
    rows = spark.range(0, 6000, 1, 3000).select(F.lit("a").alias("k"), F.array(F.col("id").cast("float"), F.lit(1.0)).alias("v"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        found = mean_pool_groups(rows, "k", "v").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r.k, r.embedding) for r in found] == [("a", [2999.5, 1.0])]
