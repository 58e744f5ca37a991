"""From CSV chunks and questions to ranked passages (K-5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions.vectors import rank_distance
from vecloom.operators.cells import CellIndex, build_cells, fit_centroids, topk_cells
from vecloom.operators.topk import topk, topk_batch
from vecloom.session import materialize, scratch_path
from vecloom.sources.chunks import read_chunks
from vecloom.sources.tables import build_vector_table, with_row_key

BROADCAST_ROWS = 200_000  # results of (question, rank, key, distance) sent to every executor


def retrieve_from(
    vectors: DataFrame,
    questions: DataFrame,
    k: int = 5,
    key: str = "id",
    text_col: str = "text",
    qid: str = "qid",
    vec: str = "embedding",
    index: CellIndex | None = None,
    nprobe: int = 8,
    wanted: float | None = None,
) -> DataFrame:
    """The k nearest passages per question, (qid, rank, key, text, distance), from stored vectors.

    With `index`, built over the same rows, only the `nprobe` cells nearest to a question are searched,
    or as many as the index is calibrated to take for a `wanted` recall.

    The search reads keys and vectors only; texts are joined to its results. Those have at
    most k rows per question, so up to `BROADCAST_ROWS` they are broadcast and the texts are
    not shuffled. Beyond that it is a shuffled join.
    """
    asked = questions.select(qid, F.col(vec).alias("_qvec"))
    if index is None:
        hits = topk_batch(vectors, asked, k, key, vec, qid, "_qvec")
    else:
        spark = vectors.sparkSession
        hits = topk_cells(spark, index, asked, None if wanted else nprobe, k, qid, "_qvec", wanted=wanted)
    if questions.count() * k <= BROADCAST_ROWS:
        hits = F.broadcast(hits)
    return vectors.select(key, text_col).join(hits, key).select(qid, "rank", key, text_col, "distance")


def ask(
    vectors: DataFrame,
    question: str,
    encode: Callable[[DataFrame, str, str], DataFrame],
    k: int = 5,
    key: str = "id",
    vec: str = "embedding",
    index: CellIndex | None = None,
    nprobe: int = 8,
) -> DataFrame:
    """The k rows of a stored vector table nearest to one question, with `distance`.

    The question is embedded once, on its own, before the table is scanned. With `index` only
    its `nprobe` nearest cells are.
    """
    asked = vectors.sparkSession.createDataFrame([(question,)], "question string")
    vector = encode(asked, "question", "vector").first()["vector"]
    if index is None:
        return topk(vectors, vector, k, key, vec)
    spark = vectors.sparkSession
    one = spark.createDataFrame([(0, vector)], "_qid int, _qvec array<double>")
    hits = topk_cells(spark, index, one, nprobe, k, "_qid", "_qvec").select(key, "distance")
    return vectors.join(F.broadcast(hits), key).orderBy(rank_distance("distance").asc_nulls_last(), key)


def retrieve(
    spark: SparkSession,
    chunks_path: str | list[str],
    questions: DataFrame,
    encode: Callable[[DataFrame, str, str], DataFrame],
    dim: int,
    k: int = 5,
    key: str | None = None,
    text_col: str = "text",
    qid: str = "qid",
    question_col: str = "question",
    table_path: str | None = None,
    schema=None,
    cells: int | DataFrame | None = None,
    nprobe: int = 8,
) -> DataFrame:
    """Read chunks, embed and store them, embed the questions, rank: (qid, rank, key, text, distance).

    `encode(df, text_col, out_col)` adds vectors, for example `embed_column` with a model or
    `embed_hash`. Without a `key` column in the CSV, rows are numbered when they are stored.
    Chunks and questions are encoded once each, before the search.
    With `cells`, a number of k-means cells or given (cell, centroid) rows, the vectors are stored by cell
    too, and a question is searched in its `nprobe` nearest cells only.
    """
    chunks = read_chunks(spark, chunks_path, text_col, schema)
    if key is None:
        key = "_row"
        chunks = with_row_key(chunks, key)
    table_path = table_path or scratch_path(spark, "chunks")
    vectors = build_vector_table(chunks, lambda df: encode(df, text_col, "embedding"), table_path, dim)
    asked = materialize(encode(questions.select(qid, question_col), question_col, "embedding"), "asked")
    index = None
    if cells is not None:
        centroids = cells
        if isinstance(cells, int):
            centroids = materialize(fit_centroids(vectors, "embedding", cells), "centroids")
        stored = vectors.select(key, text_col, "embedding")
        index = build_cells(stored, key, "embedding", scratch_path(spark, "cells"), centroids)
    return retrieve_from(vectors, asked, k, key, text_col, qid, index=index, nprobe=nprobe)
