"""Recall of cell searches: measured once, kept with the index, carried on as rows are added."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.operators import cells
from vecloom.operators.cells import (
    append_cells,
    build_cells,
    calibrate_cells,
    fit_centroids,
    nprobe_for,
    recall,
    recall_curve,
    topk_cells,
)
from vecloom.operators.topk import topk_batch
from vecloom.plans.retrieval import retrieve_from
from vecloom.session import scratch_path

SF = "/root/testdata/sf0.01"


def table(spark, vectors, first=0, id_col="id"):
    rows = [(first + i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{id_col} long, embedding array<float>")


def clustered(n, seed):
    random = np.random.default_rng(seed)
    centers = np.random.default_rng(0).normal(size=(10, 8))
    return centers[random.integers(0, 10, n)] + random.normal(size=(n, 8)) * 0.6


def built(spark, rows, n=10):
    return build_cells(rows, "id", "embedding", scratch_path(spark, "cells"), fit_centroids(rows, "embedding", n))


def curve_of(spark, index, k=None):
    return {r["nprobe"]: (r["expected"], r["hit"], r["recall"]) for r in recall_curve(spark, index, k).collect()}


def test_curve_equals_searches(spark):
    rows, asked = table(spark, clustered(400, 1)), table(spark, clustered(40, 2), id_col="qid")
    index = built(spark, rows)
    calibrate_cells(spark, index, 5, asked)
    curve, exact = curve_of(spark, index), topk_batch(rows, asked, 5)
    assert max(curve) <= 10 and len(curve) > 2
    for nprobe in curve:
        counted = recall(topk_cells(spark, index, asked, nprobe, 5), exact, "qid", "id").first()
        assert curve[nprobe] == (counted["expected"], counted["hit"], counted["recall"])
    nearest = recall(topk_cells(spark, index, asked, 1, 1), topk_batch(rows, asked, 1), "qid", "id").first()
    assert curve_of(spark, index, 1)[1] == tuple(nearest)
    with pytest.raises(ValueError, match="k from 1 to 5"):
        recall_curve(spark, index, 6)


def test_added_rows_are_searched_alone(spark, monkeypatch):
    vectors, asked = clustered(300, 3), table(spark, clustered(30, 4), id_col="qid")
    whole = built(spark, table(spark, vectors))
    calibrate_cells(spark, whole, 5, asked)
    parts = build_cells(
        table(spark, vectors[:200]), "id", "embedding", scratch_path(spark, "cells"), whole.centroids(spark)
    )
    calibrate_cells(spark, parts, 5, asked)
    before, scanned = curve_of(spark, parts), []
    real = topk_batch
    monkeypatch.setattr(cells, "topk_batch", lambda rows, *a: scanned.append(rows.count()) or real(rows, *a))
    append_cells(table(spark, vectors[200:], 200), parts)
    assert scanned == [100]
    assert curve_of(spark, parts) == curve_of(spark, whole) != before


def test_wanted_recall_holds_for_other_questions(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    others = rows.where("id % 3 = 0").select(F.col("id").alias("qid"), "embedding")
    stored = rows.where("id % 3 <> 0")
    index = built(spark, stored, 16)
    calibrate_cells(spark, index, 10, sample=200)
    exact = topk_batch(stored, others, 10)
    for wanted in (0.5, 0.9):
        found = topk_cells(spark, index, others, k=10, wanted=wanted)
        assert recall(found, exact, "qid", "id").first()["recall"] >= wanted
    assert nprobe_for(spark, index, 0.5) <= nprobe_for(spark, index, 0.9) <= nprobe_for(spark, index, 1.0) == 16


def test_odd_rows_and_settings(spark):
    vectors = [*clustered(60, 5), None, [float("nan")] * 8]
    index = built(spark, table(spark, vectors), 4)
    with pytest.raises(ValueError, match="not calibrated"):
        nprobe_for(spark, index, 0.9)
    asked = table(spark, [None, [float("inf")] * 8, *clustered(5, 6)], id_col="qid")
    # More neighbours are asked for than there are rows with vectors.
    calibrate_cells(spark, index, 100, asked)
    assert curve_of(spark, index)[4] == (300, 300, 1.0)
    # Copies: each row's neighbours are the others, itself left out.
    copies = built(spark, table(spark, [[1.0] * 8] * 30 + [[2.0] * 8] * 30), 2)
    calibrate_cells(spark, copies, 3)
    assert curve_of(spark, copies) == {1: (180, 180, 1.0)} and nprobe_for(spark, copies, 0.99) == 1
    for settings in ({}, {"nprobe": 1, "wanted": 0.9}):
        with pytest.raises(ValueError, match="either"):
            topk_cells(spark, copies, asked, **settings)
    with pytest.raises(ValueError, match="wanted recall"):
        nprobe_for(spark, copies, 0.0)


def test_calibrated_again_and_without_questions(spark):
    rows = table(spark, clustered(100, 7))
    index = built(spark, rows, 5)
    calibrate_cells(spark, index, 4, rows.limit(0).withColumnRenamed("id", "qid"))
    assert recall_curve(spark, index).count() == 0 and nprobe_for(spark, index, 0.9) == 5
    calibrate_cells(spark, index, 4)
    assert max(v[1] for v in curve_of(spark, index).values()) == 400
    passages = rows.withColumn("text", F.concat(F.lit("t"), "id"))
    asked = table(spark, clustered(3, 8), id_col="qid")
    found = retrieve_from(passages, asked, 4, index=index, wanted=1.0)
    exact = retrieve_from(passages, asked, 4)
    assert sorted(found.collect()) == sorted(exact.collect())
