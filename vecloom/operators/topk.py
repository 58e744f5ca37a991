"""Exact top-k search: one question (K-1) or a table of questions (K-2) against a vector table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vecloom.functions.vectors import rank_distance
from vecloom.operators.meet import meet
from vecloom.operators.scoring import QuestionBlock, best_rows
from vecloom.session import materialize, ship_package

QUESTION_BYTES = 64 << 20  # bound of one broadcast block of questions
_WIDEST = 4096  # width assumed where it is not known yet


def _row_bytes(width):
    """Bytes of a question of this width, its key aside."""
    return 8 * width + 64


def _key_bytes(column: str):
    return F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0))


def _result_fields(corpus: DataFrame, key: str, questions: DataFrame, qid: str):
    return questions.schema[qid].dataType, corpus.schema[key].dataType


def _scan_partials(corpus: DataFrame, columns: Sequence[str], shared, k: int, qid_type, key_type):
    """Best k rows per question of every task for a broadcast block: (qid, key, distance). No shuffle."""
    spark = corpus.sparkSession
    ship_package(spark)
    arrow_schema = pa.schema(
        [("qid", to_arrow_type(qid_type)), ("key", to_arrow_type(key_type)), ("distance", pa.float64())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from best_rows(batches, shared.value, k, arrow_schema)

    schema = f"qid {qid_type.simpleString()}, key {key_type.simpleString()}, distance double"
    return corpus.select(*columns).mapInArrow(scan, schema)


def _rank(partials: DataFrame, k: int) -> DataFrame:
    """Merge the tasks' partial results: at most k rows per question and task reach here."""
    order = Window.partitionBy("qid").orderBy(rank_distance("distance").asc_nulls_last(), "key")
    return partials.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _collect_block(questions: DataFrame, qid: str, vec: str, cells: str | None) -> QuestionBlock:
    """Bring one block of questions, whose bytes the caller has bounded, to the driver."""
    columns = [qid, vec] + ([cells] if cells else [])
    table = questions.select(*columns).toArrow().combine_chunks()
    arrays = [column.combine_chunks() if table.num_rows else column.type for column in table.columns]
    arrays = [pa.array([], type=a) if isinstance(a, pa.DataType) else a for a in arrays]
    return QuestionBlock.of(arrays[0], arrays[1], arrays[2].to_pylist() if cells else None)


def search(
    corpus: DataFrame,
    questions: DataFrame,
    k: int,
    key: str,
    vec: str,
    qid: str,
    qvec: str,
    corpus_cell: str | None = None,
    question_cells: str | None = None,
    max_question_bytes: int = QUESTION_BYTES,
    for_block=None,
    beyond=None,
) -> DataFrame:
    """Shared driver of K-2 and K-3; see `topk_batch` for how it scales.

    `for_block(corpus, block)` may narrow the scan for a block of questions. `beyond(questions, need)` gives
    the partial results of stored questions that need too many bytes for one broadcast.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    columns = [key, vec] + ([corpus_cell] if corpus_cell else [])
    qid_type, key_type = _result_fields(corpus, key, questions, qid)

    def partials(shared) -> DataFrame:
        rows = for_block(corpus, shared.value) if for_block else corpus
        return _rank(_scan_partials(rows, columns, shared, k, qid_type, key_type), k)

    def named(df: DataFrame) -> DataFrame:
        return df.select(F.col("qid").alias(qid), "rank", F.col("key").alias(key), "distance")

    kept = questions.select(*[qid, qvec] + ([question_cells] if question_cells else []))
    spark = corpus.sparkSession
    # Column pruning leaves out an encoder that makes the vectors.
    most = kept.agg(F.sum(_key_bytes(qid) + _row_bytes(_WIDEST))).first()[0] or 0
    if most <= max_question_bytes:
        return named(partials(spark.sparkContext.broadcast(_collect_block(kept, qid, qvec, question_cells))))

    # Too many to be sure they fit one broadcast: write them once and measure them.
    kept = materialize(kept, "questions")
    probes = 4 * F.coalesce(F.array_size(question_cells), F.lit(0)) if question_cells else F.lit(0)
    row = _key_bytes(qid) + _row_bytes(F.coalesce(F.array_size(qvec), F.lit(0))) + probes
    need = kept.agg(F.sum(row)).first()[0] or 0
    if need <= max_question_bytes:
        return named(partials(spark.sparkContext.broadcast(_collect_block(kept, qid, qvec, question_cells))))
    if beyond is not None:
        return named(_rank(beyond(kept, need), k))
    rows = corpus.select(F.col(key).alias("key"), F.col(vec).alias("vec"))
    asked = kept.select(F.col(qid).alias("qid"), F.col(qvec).alias("vec"))
    return named(_rank(_in_pieces(rows, asked, k, 2 * -(-need // max(1, max_question_bytes))), k))


def _in_pieces(rows: DataFrame, asked: DataFrame, k: int, n_blocks: int) -> DataFrame:
    """Every block of questions meets every part of the corpus, in one job with one scan.

    A piece is (block, part): corpus rows are there once for each block, questions once for each
    part. There are as few parts as still give every task a piece.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_parts = max(1, -(-tasks // n_blocks))
    block = F.pmod(F.xxhash64("qid"), F.lit(n_blocks))
    part = F.pmod(F.xxhash64("key"), F.lit(n_parts))
    every_part, every_block = F.sequence(F.lit(0), F.lit(n_parts - 1)), F.sequence(F.lit(0), F.lit(n_blocks - 1))
    left = asked.select("qid", "vec", block.alias("block"), F.explode(every_part).alias("part"))
    right = rows.select("key", "vec", part.alias("part"), F.explode(every_block).alias("block"))
    piece = (F.col("block") * n_parts + F.col("part")).cast("long").alias("piece")
    return meet(left.select(piece, "qid", "vec"), right.select(piece, "key", "vec"), n_blocks * n_parts, k)


def topk_batch(
    corpus: DataFrame,
    questions: DataFrame,
    k: int = 5,
    key: str = "id",
    vec: str = "embedding",
    qid: str = "qid",
    qvec: str = "embedding",
    max_question_bytes: int = QUESTION_BYTES,
) -> DataFrame:
    """The k nearest rows of `corpus` for every question: (qid, rank, key, distance).

    `key` and `qid` must be unique. The corpus is not shuffled: every task scans its own
    split for all questions and emits at most k rows per question, and only those are
    shuffled by `qid` for the final ranking. That holds for questions of at most
    `max_question_bytes`, which are broadcast. Larger tables meet the corpus in pieces, blocks of
    questions by parts of the corpus, in one job that scans the corpus once and shuffles both.
    """
    return search(corpus, questions, k, key, vec, qid, qvec, max_question_bytes=max_question_bytes)


def topk(
    corpus: DataFrame, question: Sequence[float], k: int = 5, key: str = "id", vec: str = "embedding"
) -> DataFrame:
    """The k nearest rows of `corpus` for one question vector: `corpus` columns plus `distance`.

    Only the key and vector columns go through the scan; the other columns of the k rows
    are fetched by a join on the key.
    """
    hits = topk_keys(corpus, question, k, key, vec)
    return corpus.join(hits, key).orderBy(rank_distance("distance").asc_nulls_last(), key)


def topk_keys(
    corpus: DataFrame, question: Sequence[float], k: int = 5, key: str = "id", vec: str = "embedding"
) -> DataFrame:
    """As `topk`, but only (key, distance), nearest first."""
    if k < 1:
        raise ValueError("k must be at least 1")
    vector = None if question is None else [float(x) for x in question]
    block = QuestionBlock.of(pa.array([0], pa.int32()), pa.array([vector], pa.list_(pa.float64())))
    spark = corpus.sparkSession
    shared = spark.sparkContext.broadcast(block)
    int_type = spark.range(0).select(F.lit(0).alias("q")).schema["q"].dataType
    partials = _scan_partials(corpus, [key, vec], shared, k, int_type, corpus.schema[key].dataType)
    ranked = partials.orderBy(rank_distance("distance").asc_nulls_last(), "key").limit(k)
    return ranked.select(F.col("key").alias(key), "distance")
