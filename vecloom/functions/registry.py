"""SQL names: `embed`, `embed_jina`, and the vector functions their queries use.

The vector functions are registered as Arrow UDFs because Spark does not accept a SQL-bodied
function inside ORDER BY, which is where retrieval queries use them. `vector_distance` has a SQL body and
so needs no Python worker: name it in the select list and order by its alias. DataFrame code should
use the expressions of `vecloom.functions.vectors`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vecloom.errors import VectorError
from vecloom.functions.arrow_vectors import lists_of, matrix_of, numbers_of, row_sums
from vecloom.models.artifacts import ModelRef
from vecloom.models.spec import JINA, MINILM, ModelSpec
from vecloom.operators.embed import embed_udf, model_ref
from vecloom.operators.hashing import hash_udf
from vecloom.session import ship_package


def _vector_udfs() -> dict:
    @F.arrow_udf("double")
    def array_distance(a: pa.Array, b: pa.Array) -> pa.Array:
        both = pc.and_(pc.is_valid(a), pc.is_valid(b))
        left, sizes = numbers_of(a.filter(both))
        right, others = numbers_of(b.filter(both))
        if (sizes != others).any():
            at = int(np.flatnonzero(sizes != others)[0])
            raise VectorError(f"array_distance: widths differ, {sizes[at]} and {others[at]}")
        out = np.zeros(len(a))
        out[np.asarray(both)] = np.sqrt(row_sums((left - right) ** 2, sizes))
        return pa.array(out, mask=~np.asarray(both))

    @F.arrow_udf("array<float>")
    def to_vector(v: pa.Array, width: pa.Array) -> pa.Array:
        if len(pc.unique(width)) > 1:
            raise VectorError("to_vector: the width must be a constant")
        matrix, rows = matrix_of(v, int(width[0].as_py()) if len(width) else None)
        return lists_of(matrix.astype(np.float32), rows, len(v))

    @F.arrow_udf("array<float>")
    def l2_normalize(v: pa.Array) -> pa.Array:
        flat, sizes = numbers_of(v.drop_null())
        with np.errstate(invalid="ignore"):
            unit = flat / np.repeat(np.sqrt(row_sums(flat * flat, sizes)), sizes)
        valid = np.asarray(pc.is_valid(v))
        lengths = np.zeros(len(v), np.int64)
        lengths[valid] = sizes
        offsets = pa.array(np.r_[0, np.cumsum(lengths)], pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(unit.astype(np.float32)), mask=pa.array(~valid))

    return {"array_distance": array_distance, "to_vector": to_vector, "l2_normalize": l2_normalize}


VECTOR_DISTANCE = """CREATE OR REPLACE TEMPORARY FUNCTION vector_distance(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>)
RETURNS DOUBLE RETURN CASE
  WHEN a IS NULL OR b IS NULL THEN NULL
  WHEN array_size(a) <> array_size(b) THEN CAST(raise_error(concat(
    'vector_distance: widths differ, ', array_size(a), ' and ', array_size(b))) AS DOUBLE)
  ELSE coalesce(
    sqrt(aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, (s, v) -> s + v)),
    CAST(raise_error('vector_distance: a vector has a NULL element') AS DOUBLE))
END"""


def register_vector_functions(spark: SparkSession) -> None:
    """`array_distance(a, b)`, `vector_distance(a, b)`, `to_vector(v, width)`, `l2_normalize(v)` and `embed_hash(text)`."""
    ship_package(spark)
    spark.sql(VECTOR_DISTANCE)
    for name, udf in {**_vector_udfs(), "embed_hash": hash_udf()}.items():
        spark.udf.register(name, udf)


def register(spark: SparkSession, models: tuple[str | ModelSpec | ModelRef, ...] = (MINILM, JINA)) -> None:
    """Register every SQL function. Model folders are checked here; weights load in the tasks."""
    register_vector_functions(spark)
    for ref in [model_ref(spark, model) for model in models]:
        spark.udf.register(ref.spec.name, embed_udf(ref))
