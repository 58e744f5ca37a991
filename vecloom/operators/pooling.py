"""Mean pooling over groups of rows: long form of `vecloom.functions.vectors.mean_pool`."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vecloom.functions.arrow_vectors import lists_of, matrix_of
from vecloom.session import ship_package

_GROUPS = 4096  # partial sums a task holds before it emits them
SALTS = 1024  # partial sums of a key that the last step adds, at most


class _Sums:
    """Partial sums of one task: per key a vector sum, the sum of the mask and no more."""

    def __init__(self, key_type: pa.DataType):
        self.keys = pa.array([], type=key_type)
        self.vectors = self.weights = None

    def add(self, keys: pa.Array, vectors: np.ndarray, weights: np.ndarray) -> None:
        if self.vectors is not None and len(self.vectors):
            keys = pa.concat_arrays([self.keys, keys])
            vectors = np.concatenate([self.vectors, vectors])
            weights = np.concatenate([self.weights, weights])
        groups = keys.dictionary_encode(null_encoding="encode")
        code = np.asarray(groups.indices)
        order = np.argsort(code, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(code[order]) != 0]) if len(code) else np.empty(0, int)
        self.keys = groups.dictionary
        self.vectors = np.add.reduceat(vectors[order], starts, axis=0) if len(code) else vectors
        self.weights = np.add.reduceat(weights[order], starts) if len(code) else weights

    def drain(self, schema: pa.Schema) -> pa.RecordBatch:
        sums = lists_of(self.vectors, np.arange(len(self.keys)), len(self.keys))
        batch = pa.RecordBatch.from_arrays([self.keys, sums, pa.array(self.weights)], schema=schema)
        self.keys = self.keys[:0]
        self.vectors = self.weights = None
        return batch


def mean_pool_groups(
    df: DataFrame, key: str, vec: str, mask: str | None = None, out_col: str = "embedding"
) -> DataFrame:
    """One vector per key: sum(v * m) / max(sum(m), 1e-8), with m = 1 where no mask is given.

    Tasks sum their rows before the shuffle, so a key that holds most of the table costs the
    shuffle one row per task. Partial sums are then added in two levels, first those of a key and salt
    (task number modulo SALTS), then those of a key: with a million tasks no step gathers more than
    about a thousand arrays. A key whose vectors are all NULL gets a NULL vector.
    """
    spark = df.sparkSession
    ship_package(spark)
    key_type = df.schema[key].dataType
    fields = [("k", to_arrow_type(key_type)), ("sums", pa.list_(pa.float64())), ("weight", pa.float64())]
    schema, salted = pa.schema(fields), pa.schema([*fields, ("salt", pa.int32())])
    weight = F.col(mask).cast("double") if mask else F.lit(1.0)
    rows = df.select(F.col(key).alias("k"), F.col(vec).alias("v"), weight.alias("m"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(schema.field(0).type)
        for batch in batches:
            present = pc.is_valid(batch.column(1))
            bare = pc.unique(batch.column(0).cast(schema.field(0).type).filter(pc.invert(present)))
            if len(bare):
                nothing = [pa.nulls(len(bare), schema.field(1).type), pa.array([0.0] * len(bare))]
                yield pa.RecordBatch.from_arrays([bare, *nothing], schema=schema)
            batch = batch.filter(present)
            if not batch.num_rows:
                continue
            matrix, _ = matrix_of(batch.column(1))
            m = np.asarray(pc.fill_null(batch.column(2), 0.0))
            sums.add(batch.column(0).cast(schema.field(0).type), matrix * m[:, None], m)  # m makes it double
            if len(sums.keys) > _GROUPS:
                yield sums.drain(schema)
        if sums.vectors is not None and len(sums.keys):
            yield sums.drain(schema)

    def with_salt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % SALTS
        for batch in partial(batches):
            salts = pa.array(np.full(batch.num_rows, salt, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, salts], schema=salted)

    ddl = f"k {key_type.simpleString()}, sums array<double>, weight double, salt int"
    total = _added(_added(rows.mapInArrow(with_salt, ddl), "k", "salt"), "k")
    vector = F.transform("sums", lambda x: (x / F.greatest(F.col("weight"), F.lit(1e-8))).cast("float"))
    return total.select(F.col("k").alias(key), vector.alias(out_col))


def _added(parts: DataFrame, *keys: str) -> DataFrame:
    """(keys, sums, weight): the sums and weights of each group added; NULL sums count as nothing."""
    grouped = parts.groupBy(*keys).agg(
        F.filter(F.collect_list(F.struct("sums", "weight")), lambda p: p["sums"].isNotNull()).alias("parts")
    )
    first = F.get("parts", F.lit(0))["sums"]
    rest = F.slice("parts", 2, F.greatest(F.size("parts"), F.lit(1)))
    sums = F.aggregate(rest, first, lambda s, p: F.zip_with(s, p["sums"], lambda x, y: x + y))
    weight = F.aggregate("parts", F.lit(0.0), lambda s, p: s + p["weight"])
    return grouped.select(*keys, F.when(F.size("parts") > 0, sums).alias("sums"), weight.alias("weight"))
