"""Approximate similarity join by locality-sensitive hashing (K-4).

A vector's signature has one code per table. A code combines `width` random projections,
each cut into intervals of `bucket_length` (p-stable hashing of Datar et al., 2004). Rows
are compared where they share a code in some table.

Where one side fits a broadcast, the other is scanned in place and nothing is shuffled: each
task looks its rows' codes up in the small side. Otherwise both sides are shuffled by code,
in pieces of bounded size whatever the data looks like:

- Equal vectors are joined once, through their first key, and expanded afterwards.
- A bucket with more than `block_rows` rows on a side is split into blocks, and every block
  of one side meets every block of the other, each pair of blocks on its own. A row is shuffled once
  for each block it meets, so there are at most `MOST_BLOCKS` of a side and blocks grow with the
  bucket instead, up to `BLOCK_BYTES`.
- A task reads its pieces in order, one at a time; distances come from one matrix product per
  piece, and only pairs within `max_dist` leave it. A pair that shares several codes is
  reported by the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vecloom.functions.arrow_vectors import matrix_of
from vecloom.operators.scoring import pair_distances, squared_products
from vecloom.session import materialize, ship_package

BROADCAST_BUCKETS = 200_000  # large buckets, by (table, code, two counts), sent to every executor
SMALL_SIDE_BYTES = 64 << 20  # a side up to this size is broadcast
MOST_BLOCKS = 8  # blocks of a bucket's side, as long as one takes no more than BLOCK_BYTES
BLOCK_BYTES = 32 << 20
_PRODUCTS = 1 << 22  # distance-matrix cells held at once


def random_projections(dim: int, tables: int, width: int, bucket_length: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Normal directions [tables * width, dim] and uniform offsets in [0, bucket_length)."""
    rng = np.random.default_rng(seed)
    return rng.standard_normal((tables * width, dim)), rng.uniform(0, bucket_length, tables * width)


@dataclass(frozen=True)
class Hashing:
    """Projections and interval length of one join."""

    directions: np.ndarray
    offsets: np.ndarray
    tables: int
    bucket_length: float

    def codes(self, matrix: np.ndarray) -> pa.Array:
        """Codes of finite vectors, table by table within each row.

        A code is the list of its interval numbers, so different buckets never share a code.
        """
        shifted = matrix.astype(np.float64) @ self.directions.T + self.offsets
        intervals = np.floor(shifted / self.bucket_length).astype(np.int64)
        parts = intervals.reshape(-1, len(self.directions) // self.tables).T
        return pc.binary_join_element_wise(*[pa.array(part).cast(pa.string()) for part in parts], ",")

    def usable(self, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The finite vectors and their row positions."""
        matrix, rows = matrix_of(vectors, self.directions.shape[1])
        finite = np.isfinite(matrix).all(axis=1)
        return matrix[finite], rows[finite]


def signature_udf(hashing: Hashing):
    """Arrow UDF `vector -> array<string>`: the code of each table; NULL for unusable vectors."""

    @F.arrow_udf("array<string>")
    def signature(vectors: pa.Array) -> pa.Array:
        matrix, rows = hashing.usable(vectors)
        present = np.zeros(len(vectors), dtype=bool)
        present[rows] = True
        offsets = np.r_[0, np.cumsum(present * hashing.tables)].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), hashing.codes(matrix), mask=pa.array(~present))

    return signature


def _distinct_vectors(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(rep, v, n): each different vector, its first key and its number of rows.

    Copies collapse before the shuffle.
    """
    rows = df.select(F.col(key).alias("key"), F.col(vec).alias("v"))
    return rows.groupBy("v").agg(F.min("key").alias("rep"), F.count("*").alias("n"))


def _bucket_rows(signed: DataFrame) -> DataFrame:
    """One row per table: (rep, v, codes, table, code)."""
    return signed.select("rep", "v", "codes", F.posexplode("codes").alias("table", "code"))


def block_count(rows: Column, block_rows: int, dim: int) -> Column:
    """Blocks of a bucket's side with so many rows, of vectors of width `dim`; 1 where the number is NULL."""
    widest = max(block_rows, BLOCK_BYTES // (8 * dim + 128))
    wanted = F.least(F.ceil(rows / F.lit(block_rows)), F.lit(MOST_BLOCKS))
    most = F.greatest(wanted, F.ceil(rows / F.lit(widest))).cast("int")
    return F.when(rows.isNotNull(), most).otherwise(F.lit(1))


def _blocks(rows: DataFrame, hot: DataFrame, own: str, other: str, block_rows: int, dim: int) -> DataFrame:
    """Give each row its block on its own side, and one copy per block of the other side.

    Only rows of large buckets are in more than one piece: all others are block 0 of 1.
    """

    def count(side: str):
        return block_count(F.col(f"n_{side}"), block_rows, dim)

    own_block = F.pmod(F.xxhash64("rep"), count(own)).cast("int")
    other_block = F.explode(F.sequence(F.lit(0), count(other) - 1))
    placed = rows.join(hot, ["table", "code"], "left")
    return placed.withColumn(f"block_{own}", own_block).withColumn(f"block_{other}", other_block)


def _near_pairs(
    left: np.ndarray, right: np.ndarray, max_dist: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions and distances of the pairs within `max_dist`, a bounded part at a time."""
    step = max(1, _PRODUCTS // max(1, len(right)))
    for at in range(0, len(left), step):
        squares, slack = squared_products(left[at : at + step], right)
        i, j = np.nonzero(squares <= (max_dist * max_dist + slack)[:, None])
        distance = pair_distances(left[at : at + step], right, i, j)
        near = distance <= max_dist
        yield i[near] + at, j[near], distance[near]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Rows sorted by `piece`, cut so that no piece is split: a table and its pieces' bounds."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]).combine_chunks() if rest is not None else rows
        bounds = _bounds(rows)
        rest = rows.slice(bounds[-1][0])  # the last piece may go on in the next batch
        yield rows, bounds[:-1]
    if rest is not None:
        yield rest.combine_chunks(), [(0, rest.num_rows)]


def _bounds(rows: pa.Table) -> list[tuple[int, int]]:
    piece = rows.column("piece").combine_chunks()
    cuts = np.flatnonzero(np.asarray(pc.not_equal(piece[1:], piece[:-1]))) + 1
    return list(zip(np.r_[0, cuts].tolist(), np.r_[cuts, rows.num_rows].tolist(), strict=True))


def candidate_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """(table, code, n_a, n_b) of the codes found on both sides, from two (table, code) tables."""
    n_a = a.groupBy("table", "code").agg(F.count("*").alias("n_a"))
    n_b = b.groupBy("table", "code").agg(F.count("*").alias("n_b"))
    return n_a.join(n_b, ["table", "code"])


def _comparisons(a: DataFrame, b: DataFrame, vec: str, hashing: Hashing) -> int:
    sign = signature_udf(hashing)
    sides = [df.select(F.posexplode(sign(vec)).alias("table", "code")) for df in (a, b)]
    return candidate_pairs(*sides).agg(F.sum(F.col("n_a") * F.col("n_b"))).first()[0] or 0


class _CodeBook:
    """The small side of a scan: its vectors, and for each table its codes and their rows."""

    def __init__(self, rows: pa.Table, hashing: Hashing):
        self.matrix, own = hashing.usable(rows.column(1).combine_chunks() if rows.num_rows else pa.array([], rows[1].type))
        self.keys = rows.column(0).take(pa.array(own)).combine_chunks()
        codes = hashing.codes(self.matrix)
        self.values, self.members, ids = [], [], []
        for table in range(hashing.tables):
            coded = codes.take(pa.array(np.arange(table, len(codes), hashing.tables))).dictionary_encode()
            number = np.asarray(coded.indices)
            order = np.argsort(number, kind="stable")
            self.values.append(coded.dictionary)
            self.members.append(np.split(order, np.flatnonzero(np.diff(number[order])) + 1))
            ids.append(number)
        self.ids = np.stack(ids, axis=1)


def _scan_join(
    large: DataFrame, small: DataFrame, key_large: str, key_small: str, vec: str, max_dist: float, hashing: Hashing
) -> DataFrame:
    """Pairs (key_large, key_small, distance) without a shuffle; `small` has a checked size."""
    spark = large.sparkSession
    types = large.schema[key_large].dataType, small.schema[key_small].dataType
    schema = pa.schema(
        [(key_large, to_arrow_type(types[0])), (key_small, to_arrow_type(types[1])), ("distance", pa.float64())]
    )
    shared = spark.sparkContext.broadcast(_CodeBook(small.select(key_small, vec).toArrow(), hashing))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        for batch in batches:
            matrix, rows = hashing.usable(batch.column(1))
            keys, codes = batch.column(0).take(pa.array(rows)), hashing.codes(matrix)
            ids = np.full((len(matrix), hashing.tables), -1, dtype=np.int64)
            for table, values in enumerate(book.values):
                own = codes.take(pa.array(np.arange(table, len(codes), hashing.tables)))
                ids[:, table] = np.asarray(pc.fill_null(pc.index_in(own, value_set=values), -1))
            for table, members in enumerate(book.members):
                found = np.flatnonzero(ids[:, table] >= 0)
                found = found[np.argsort(ids[found, table], kind="stable")]
                for at_large in np.split(found, np.flatnonzero(np.diff(ids[found, table])) + 1):
                    if not len(at_large):
                        continue
                    at_small = members[ids[at_large[0], table]]
                    for i, j, distance in _near_pairs(matrix[at_large], book.matrix[at_small], max_dist):
                        i, j = at_large[i], at_small[j]
                        first = ~(ids[i, :table] == book.ids[j, :table]).any(axis=1)
                        if first.any():
                            columns = [keys.take(pa.array(i[first])), book.keys.take(pa.array(j[first]))]
                            yield pa.RecordBatch.from_arrays([*columns, pa.array(distance[first])], schema=schema)

    ddl = f"`{key_large}` {types[0].simpleString()}, `{key_small}` {types[1].simpleString()}, distance double"
    return large.select(key_large, vec).mapInArrow(scan, ddl)


def lsh_join(
    a: DataFrame,
    b: DataFrame,
    max_dist: float,
    key_a: str,
    key_b: str,
    vec: str = "embedding",
    bucket_length: float = 1.0,
    tables: int = 4,
    width: int = 1,
    seed: int = 42,
    block_rows: int = 2048,
    expand_copies: bool = True,
    projections: tuple[np.ndarray, np.ndarray] | None = None,
    stats: dict | None = None,
    broadcast_bytes: int = SMALL_SIDE_BYTES,
) -> DataFrame:
    """Pairs (key_a, key_b, distance) within `max_dist` that share a code in some table.

    Both sides should be stored tables: they are read more than once, and their copies are
    found by equal vectors. The two key columns need different names. `expand_copies=False` returns each pair of
    different vectors once, under the first key of each, for tables where equal vectors are
    so many that their pairs are not wanted one by one. `stats`, if given, receives
    `candidates`, the number of comparisons, and `pairs`, the size of the full cross product.
    """
    spark = a.sparkSession
    ship_package(spark)
    firsts = [df.where(F.col(vec).isNotNull()).select(F.array_size(vec)).first() for df in (a, b)]
    dim = next((first[0] for first in firsts if first), 1)
    if projections is None:
        projections = random_projections(dim, tables, width, bucket_length, seed)
    hashing = Hashing(*projections, tables, bucket_length)
    if expand_copies:
        rows_a, rows_b = a.count(), b.count()
        if min(rows_a, rows_b) * (8 * dim + 64 + 32 * tables) <= broadcast_bytes:
            if stats is not None:
                stats.update(candidates=_comparisons(a, b, vec, hashing), pairs=rows_a * rows_b)
            large, small, names = (a, b, (key_a, key_b)) if rows_b <= rows_a else (b, a, (key_b, key_a))
            return _scan_join(large, small, *names, vec, max_dist, hashing).select(key_a, key_b, "distance")
    sign = signature_udf(hashing)

    def signed(df: DataFrame, key: str, label: str) -> DataFrame:
        rows = _distinct_vectors(df, key, vec).withColumn("codes", sign("v"))
        return materialize(rows, label).where("codes IS NOT NULL")

    signed_a, signed_b = signed(a, key_a, "lsh-a"), signed(b, key_b, "lsh-b")
    rows_a, rows_b = _bucket_rows(signed_a), _bucket_rows(signed_b)
    sizes = materialize(candidate_pairs(rows_a, rows_b), "lsh-sizes")
    large = (F.col("n_a") > block_rows) | (F.col("n_b") > block_rows)
    totals = sizes.agg(
        F.sum(F.col("n_a") * F.col("n_b")).alias("candidates"), F.count_if(large).alias("hot")
    ).first()
    if stats is not None:
        stats["candidates"], stats["pairs"] = totals["candidates"] or 0, a.count() * b.count()
    hot = sizes.where(large)
    if totals["hot"] <= BROADCAST_BUCKETS:
        hot = F.broadcast(hot)
    types = (rows_a.schema["rep"].dataType, rows_b.schema["rep"].dataType)
    piece = F.concat_ws("/", "table", "block_a", "block_b", "code").alias("piece")
    vector = F.col("v").cast("array<double>") if signed_a.schema["v"] != signed_b.schema["v"] else F.col("v")
    shared = [piece, "table", vector.alias("v"), "codes"]
    none_a, none_b = F.lit(None).cast(types[0]).alias("rep_a"), F.lit(None).cast(types[1]).alias("rep_b")
    side_a = _blocks(rows_a, hot, "a", "b", block_rows, hashing.directions.shape[1]).select(*shared, F.col("rep").alias("rep_a"), none_b)
    side_b = _blocks(rows_b, hot, "b", "a", block_rows, hashing.directions.shape[1]).select(*shared, none_a, F.col("rep").alias("rep_b"))
    arrow_schema = pa.schema(
        [("rep_a", to_arrow_type(types[0])), ("rep_b", to_arrow_type(types[1])), ("distance", pa.float64())]
    )

    def join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in _pieces(batches):
            if not bounds:
                continue
            matrix, _ = matrix_of(rows.column("v").combine_chunks())
            codes = rows.column("codes").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            codes = codes.reshape(rows.num_rows, -1)
            keys_a, keys_b = rows.column("rep_a").combine_chunks(), rows.column("rep_b").combine_chunks()
            table, in_a = np.asarray(rows.column("table")), np.asarray(pc.is_valid(keys_a))
            for start, end in bounds:
                at_a, at_b = start + np.flatnonzero(in_a[start:end]), start + np.flatnonzero(~in_a[start:end])
                if not len(at_a) or not len(at_b):
                    continue
                earlier = table[start]
                for i, j, distance in _near_pairs(matrix[at_a], matrix[at_b], max_dist):
                    i, j = at_a[i], at_b[j]
                    first = ~(codes[i, :earlier] == codes[j, :earlier]).any(axis=1)
                    if first.any():
                        columns = [keys_a.take(pa.array(i[first])), keys_b.take(pa.array(j[first]))]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(distance[first])], schema=arrow_schema)

    ddl = f"rep_a {types[0].simpleString()}, rep_b {types[1].simpleString()}, distance double"
    sorted_pieces = side_a.unionByName(side_b).repartition("piece").sortWithinPartitions("piece")
    found = sorted_pieces.mapInArrow(join_pieces, ddl)
    if not expand_copies:
        return found.select(F.col("rep_a").alias(key_a), F.col("rep_b").alias(key_b), "distance")
    for df, signed_rows, key, rep in ((a, signed_a, key_a, "rep_a"), (b, signed_b, key_b, "rep_b")):
        if signed_rows.where("n > 1").isEmpty():
            found = found.withColumnRenamed(rep, key)
        else:
            found = found.join(_members(df, key, vec, signed_rows).withColumnRenamed("rep", rep), rep)
    return found.select(key_a, key_b, "distance")


def _members(df: DataFrame, key: str, vec: str, distinct: DataFrame) -> DataFrame:
    """(rep, key) of every row, given the distinct vectors. Only vectors with copies are looked up again."""
    alone = distinct.where("n = 1").select("rep", F.col("rep").alias(key))
    repeated = distinct.where("n > 1").select("v", "rep")
    copies = df.select(F.col(key), F.col(vec).alias("v")).join(repeated, "v")
    return alone.unionByName(copies.select("rep", key))


def copy_groups(df: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    """(rep, key): every row with the first key among the rows that have the same vector."""
    return _members(df, key, vec, materialize(_distinct_vectors(df, key, vec), "distinct"))
