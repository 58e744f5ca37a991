"""Approximate similarity join of one table with itself (K-4), over the codes of `operators.lsh`.

The table is signed once. Equal vectors are one row, under their first key. Rows meet in the buckets
of their codes, each pair of rows once: a bucket of more than `block_rows` rows is cut into blocks, as
many as `lsh.block_count` says (so that a row is shuffled a bounded number of times), and only the pairs of blocks i <= j are pieces, so half of the comparisons of a join of two copies are made.

Buckets that hold more than `max_bucket` rows can be split further: their rows get one more projection in
that table, level by level, until no bucket is larger or `levels` are used up. A split loses pairs whose
ends fall into different intervals; without it (`levels=0`) every pair that shares a code is found.
What is still large then is compared in blocks, so nothing is dropped and no task's input grows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vecloom.functions.arrow_vectors import matrix_of
from vecloom.operators.lsh import (
    BROADCAST_BUCKETS,
    Hashing,
    _bounds,
    _bucket_rows,
    _distinct_vectors,
    _near_pairs,
    _pieces,
    block_count,
    copy_groups,
    random_projections,
    signature_udf,
)
from vecloom.session import materialize, ship_package

_STRIP = 512  # rows of a block that are compared with those after them at once


def _refiner(directions: np.ndarray, offsets: np.ndarray, bucket_length: float):
    """Arrow UDF (v, codes, tables) -> codes, with one more interval number in the given tables.

    Every table has a direction of its own, so a pair that is split in one may stay together in another.
    """

    @F.arrow_udf("array<string>")
    def refine(vectors: pa.Array, codes: pa.Array, tables: pa.Array) -> pa.Array:
        matrix, _ = matrix_of(vectors, directions.shape[1])
        number = np.floor((matrix.astype(np.float64) @ directions.T + offsets) / bucket_length).astype(np.int64)
        out = codes.to_pylist()
        for row, more in enumerate(tables.to_pylist()):
            for table in more or ():
                out[row][table] += f",{number[row, table]}"
        return pa.array(out, pa.list_(pa.string()))

    return refine


def _sizes(signed: DataFrame) -> DataFrame:
    """(table, code, n) of the buckets with more than one row."""
    codes = signed.select(F.posexplode("codes").alias("table", "code"))
    return codes.groupBy("table", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _refined(signed: DataFrame, sizes: DataFrame, max_bucket: int, hashing: Hashing, seed: int) -> DataFrame:
    """`signed` with one more projection for the rows of large buckets, in those tables."""
    dim = hashing.directions.shape[1]
    directions, offsets = random_projections(dim, hashing.tables, 1, hashing.bucket_length, seed)
    large = sizes.where(F.col("n") > max_bucket).select("table", "code")
    codes = signed.select("rep", F.posexplode("codes").alias("table", "code"))
    # At most one entry for each table.
    marked = codes.join(large, ["table", "code"]).groupBy("rep").agg(F.collect_list("table").alias("tables"))
    joined = signed.join(marked, "rep", "left")
    refine = _refiner(directions, offsets, hashing.bucket_length)
    return materialize(joined.select("rep", "v", "n", refine("v", "codes", "tables").alias("codes")), "lsh-refined")


def _placed(signed: DataFrame, large: DataFrame, block_rows: int, dim: int) -> DataFrame:
    """Each row with its block, once for each pair of blocks that it is in."""
    rows = _bucket_rows(signed).join(large.withColumnRenamed("n", "bucket"), ["table", "code"], "left")
    count = block_count(F.col("bucket"), block_rows, dim)
    own = F.pmod(F.xxhash64("rep"), F.col("count")).cast("int")
    placed = rows.withColumn("count", count).withColumn("own", own)
    placed = placed.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    low, high = F.least("own", "partner"), F.greatest("own", "partner")
    return placed.select(
        F.concat_ws("/", "table", low, high, "code").alias("piece"), "table", "v", "codes", "rep", "own", (low == high).alias("one")
    )


def _strips(at: np.ndarray, own: np.ndarray, one: bool) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Rows to compare: a block with another one, or strips of a block with what follows them."""
    if not one:
        first = own[at] == own[at].min()
        yield at[first], at[~first], False  # nothing, if one of the two blocks is empty
        return
    for begin in range(0, len(at) - 1, _STRIP):
        yield at[begin : begin + _STRIP], at[begin:], True


def lsh_self_join(
    df: DataFrame,
    max_dist: float,
    key: str,
    other: str,
    vec: str = "embedding",
    bucket_length: float = 1.0,
    tables: int = 4,
    width: int = 1,
    seed: int = 42,
    block_rows: int = 2048,
    expand_copies: bool = False,
    projections: tuple[np.ndarray, np.ndarray] | None = None,
    stats: dict | None = None,
    max_bucket: int | None = None,
    levels: int = 0,
) -> DataFrame:
    """Pairs (key, other, distance) with key < other, within `max_dist`, that share a code in some table.

    Each pair comes once, of different vectors and under the first key of each; `copy_groups` tells which
    keys have the same vector. `expand_copies` gives the pairs of all keys instead, those of equal
    vectors among them, which are as many as the square of a group of copies. Vectors that
    are NULL or not finite are in no pair. `stats` receives `candidates` (comparisons), `pairs` (of
    different vectors) and `levels` (used). Keys must be unique, and the table stored.
    """
    spark = df.sparkSession
    ship_package(spark)
    first = df.where(F.col(vec).isNotNull()).select(F.array_size(vec)).first()
    if projections is None:
        projections = random_projections(first[0] if first else 1, tables, width, bucket_length, seed)
    hashing = Hashing(*projections, tables, bucket_length)
    sign = signature_udf(hashing)
    signed = materialize(_distinct_vectors(df, key, vec).withColumn("codes", sign("v")), "lsh-signed")
    signed = signed.where("codes IS NOT NULL")
    sizes = materialize(_sizes(signed), "lsh-sizes")
    used = 0
    while max_bucket is not None and used < levels and not sizes.where(F.col("n") > max_bucket).isEmpty():
        used += 1
        signed = _refined(signed, sizes, max_bucket, hashing, seed + used)
        sizes = materialize(_sizes(signed), "lsh-sizes")
    if stats is not None:
        n = signed.count()
        candidates = sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0
        stats.update(candidates=int(candidates), pairs=n * (n - 1) // 2, levels=used)
    large = sizes.where(F.col("n") > block_rows)
    if large.count() <= BROADCAST_BUCKETS:
        large = F.broadcast(large)
    kind = signed.schema["rep"].dataType
    schema = pa.schema([("rep", to_arrow_type(kind)), ("other", to_arrow_type(kind)), ("distance", pa.float64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in _pieces(batches):
            if not bounds:
                continue
            matrix, _ = matrix_of(rows.column("v").combine_chunks())
            codes = rows.column("codes").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            codes = codes.reshape(rows.num_rows, -1)
            keys = rows.column("rep").combine_chunks().cast(schema.field(0).type)
            table, own, one = (np.asarray(rows.column(name)) for name in ("table", "own", "one"))
            for start, end in bounds:
                if end - start < 2:
                    continue
                earlier = table[start]
                for left, right, one_block in _strips(np.arange(start, end), own, one[start]):
                    for i, j, distance in _near_pairs(matrix[left], matrix[right], max_dist):
                        if one_block:
                            later = j > i
                            i, j, distance = i[later], j[later], distance[later]
                        i, j = left[i], right[j]
                        fresh = ~(codes[i, :earlier] == codes[j, :earlier]).any(axis=1)
                        if fresh.any():
                            a, b = keys.take(pa.array(i[fresh])), keys.take(pa.array(j[fresh]))
                            swap = pc.greater(a, b)
                            columns = [pc.if_else(swap, b, a), pc.if_else(swap, a, b), pa.array(distance[fresh])]
                            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    pieces = _placed(signed, large, block_rows, hashing.directions.shape[1]).repartition("piece").sortWithinPartitions("piece")
    name = kind.simpleString()
    found = pieces.mapInArrow(compare, f"rep {name}, other {name}, distance double")
    if not expand_copies:
        return found.select(F.col("rep").alias(key), F.col("other").alias(other), "distance")
    members = materialize(copy_groups(df, key, vec), "members")
    mine = members.select("rep", F.col(key).alias("a"))
    theirs = members.select(F.col("rep").alias("other"), F.col(key).alias("b"))
    across = found.join(mine, "rep").join(theirs, "other").select("a", "b", "distance")
    several = signed.where("n > 1").select("rep")
    one, two = mine.join(several, "rep"), theirs.withColumnRenamed("other", "rep")
    within = one.join(two, "rep").where("a < b").select("a", "b", F.lit(0.0).alias("distance"))
    ordered = across.unionByName(within)
    return ordered.select(F.least("a", "b").alias(key), F.greatest("a", "b").alias(other), "distance")


def pair_recall(found: DataFrame, df: DataFrame, max_dist: float, key: str, other: str, vec: str, sample: DataFrame) -> float:
    """Share of the true pairs of `sample`, a few (key, vec) rows of `df`, that `found` has, in compact form.

    The true pairs come from a scan of `df` for the sampled rows only.
    """
    from vecloom.operators.lsh import lsh_join

    distinct = _distinct_vectors(df, key, vec).select(F.col("rep").alias(other), F.col("v").alias(vec))
    asked = _distinct_vectors(sample.select(key, vec), key, vec).select(F.col("rep").alias("_asked"), F.col("v").alias(vec))
    one_bucket = (np.zeros((1, asked.select(F.array_size(vec)).first()[0])), np.zeros(1))
    near = lsh_join(materialize(distinct, "distinct"), materialize(asked, "sample"), max_dist, other, "_asked", vec,
                    tables=1, projections=one_bucket)
    true = near.where(F.col("_asked") != F.col(other)).select(
        F.least("_asked", other).alias(key), F.greatest("_asked", other).alias(other)
    ).distinct()
    counts = true.join(found.select(key, other, F.lit(1).alias("hit")), [key, other], "left")
    total, hit = counts.agg(F.count(F.lit(1)), F.count("hit")).first()
    return hit / total if total else 1.0
