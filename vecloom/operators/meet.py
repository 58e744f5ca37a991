"""Meeting questions and rows in pieces, where the questions don't fit one broadcast.

Both sides carry the number of the piece they meet in. One shuffle brings a piece's rows together,
questions first; a task holds the questions of one piece at a time and streams its rows past
them, so what it holds is bounded by the questions of a piece. A row or question
that takes part in several pieces is there once for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vecloom.operators.scoring import QuestionBlock, best_rows
from vecloom.session import ship_package


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(piece, side, rows) of batches sorted by piece and side."""
    for batch in batches:
        if not batch.num_rows:
            continue
        piece, side = batch["piece"].to_numpy(), batch["side"].to_numpy()
        cuts = np.flatnonzero((piece[1:] != piece[:-1]) | (side[1:] != side[:-1])) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(piece)], strict=True):
            yield piece[begin], side[begin], batch.slice(begin, end - begin)


def _met(batches: Iterator[pa.RecordBatch], k: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for _, parts in groupby(_runs(batches), key=lambda run: run[0]):
        asked, first = [], []
        for _, side, part in parts:
            if side:
                first = [part]
                break
            asked.append(part)
        if not asked:
            continue  # rows that no question asks for
        table = pa.Table.from_batches(asked).combine_chunks()
        keys = table["qid"].combine_chunks().cast(schema.field(0).type)
        block = QuestionBlock.of(keys, table["vec"].combine_chunks())
        rows = chain(first, (part for _, _, part in parts))
        yield from best_rows((part.select(["key", "vec"]) for part in rows), block, k, schema)


def meet(questions: DataFrame, rows: DataFrame, n_pieces: int, k: int) -> DataFrame:
    """(qid, key, distance): the k nearest rows of each question in each piece.

    From (piece, qid, vec) and (piece, key, vec) with pieces from 0 to `n_pieces` - 1. Pieces are
    dealt out by their number, so no two tasks differ by more than one piece.
    """
    spark = rows.sparkSession
    ship_package(spark)
    qid_type, key_type = questions.schema["qid"].dataType, rows.schema["key"].dataType
    same = questions.schema["vec"].dataType == rows.schema["vec"].dataType
    vector = F.col("vec") if same else F.col("vec").cast("array<double>")
    left = questions.select("piece", F.lit(0).alias("side"), "qid", F.lit(None).cast(key_type).alias("key"), vector.alias("vec"))
    right = rows.select("piece", F.lit(1).alias("side"), F.lit(None).cast(qid_type).alias("qid"), "key", vector.alias("vec"))
    tasks = max(1, min(n_pieces, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = left.unionByName(right).repartitionById(tasks, F.pmod("piece", F.lit(tasks)).cast("int"))
    schema = pa.schema(
        [("qid", to_arrow_type(qid_type)), ("key", to_arrow_type(key_type)), ("distance", pa.float64())]
    )
    return dealt.sortWithinPartitions("piece", "side").mapInArrow(
        lambda batches: _met(batches, k, schema),
        f"qid {qid_type.simpleString()}, key {key_type.simpleString()}, distance double",
    )
