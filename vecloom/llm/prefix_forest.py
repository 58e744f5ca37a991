"""Operator 1: approximate nearest neighbours by a forest of hash prefixes.

Each of TREES trees gives every vector a string of 64 sign bits of random projections; a tree is
its vectors sorted by that string. A query descends to its longest prefix match in a tree and
from there ascends: with each shorter prefix the run of sorted vectors that share it grows at both
ends, and the new ones are scored. It stops at the prefix length x at which a vector as good as
the k-th best found would have been met with the wanted probability: with p the chance that such
a vector shares a bit, 1 - (1 - p**x)**TREES. All trees end at the same length or deeper.

Trees are cut into shards of vectors that share their first bits, at first as many as the rule
gives for a bounded sample (SAMPLE rows). A query that has met fewer than k vectors in its shards,
or whose own k-th best asks for a shorter prefix, goes on in another round in shards of shorter
prefixes, until its own rule is fulfilled or it has met all vectors (prefix 0, one tree). A shard
with more than SHARD_ROWS vectors is dealt out over several tasks, its queries likewise.
Of equal vectors only the k + 1 smallest ids can be among the nearest k, so one is indexed,
with those ids. Vectors of unequal length get one more coordinate, which makes them equally
long and leaves inner products with queries as they are.
"""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecloom.session import materialize, ship_package

TREES = 16
TARGET = 0.95
SAMPLE = 2000
SHARD_ROWS = 16_384
QUERY_ROWS = 2048
SEED = 7


def _clean(vectors: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(id, v array<double>) of the vectors that take part."""
    v = F.col(vec).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        vectors.select(F.col(id_col).alias("id"), v.alias("v"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull())
        .where(fine & F.exists("v", lambda x: x != 0))
    )


def _projections(width: int) -> np.ndarray:
    """64 directions for each tree, orthogonal in runs of `width`."""
    rng = np.random.default_rng(SEED)
    parts = []
    while sum(p.shape[1] for p in parts) < 64 * TREES:
        parts.append(np.linalg.qr(rng.standard_normal((width, width)))[0])
    return np.concatenate(parts, axis=1)[:, : 64 * TREES]


def codes(v: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Strings of all trees, as rows x TREES numbers whose bits are in order."""
    out = np.empty((len(v), TREES), np.uint64)
    for low in range(0, len(v), 4096):
        bits = v[low : low + 4096] @ directions > 0
        packed = np.packbits(bits.reshape(len(bits), TREES, 64), axis=2)
        out[low : low + 4096] = packed.view(">u8")[:, :, 0]
    return out


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1)


def _longer(v: np.ndarray, norm: float | None) -> np.ndarray:
    """One more coordinate: 0 for queries (`norm` None), what is missing to `norm` for the others."""
    more = np.zeros(len(v)) if norm is None else np.sqrt(np.maximum(norm * norm - (v * v).sum(axis=1), 0))
    return np.column_stack([v, more])


def depth_for(cosine: float) -> int:
    """Longest prefix at which a vector of this cosine is met with probability TARGET."""
    p = 1 - math.acos(min(1.0, max(-1.0, cosine))) / math.pi
    if p >= 1:
        return 64
    need = 1 - (1 - TARGET) ** (1 / TREES)
    return max(0, min(64, int(math.log(need) / math.log(p)))) if p > 0 else 0


def _base_depth(rows: DataFrame, queries: DataFrame, total: int, k: int) -> int:
    """The depth to begin with: right for most of at most SAMPLE queries, by SAMPLE rows."""
    def some(df, salt):
        return _matrix(df.orderBy(F.xxhash64("id", F.lit(salt))).limit(SAMPLE).select("v").toArrow()["v"])

    a, b = some(rows, 1), some(queries, 2)
    if not len(a) or not len(b) or total <= k:
        return 0
    norm = np.linalg.norm(a, axis=1).max()
    cosines = np.sort(b @ a.T / (np.linalg.norm(b, axis=1, keepdims=True) * norm), axis=1)
    n = cosines.shape[1]
    own = cosines[:, max(0, min(n - 1, int(n * (1 - k / total))))]
    if k / total < 1 / n < 0.5:  # further out than the sample reaches: as in a normal distribution
        mean, z = cosines.mean(axis=1), NormalDist().inv_cdf
        own = mean + (own - mean) * z(1 - k / total) / z(1 - 1 / n)
    return min(20, depth_for(float(np.quantile(own, 0.05))))


def _own_depth(cosine, deepest: int):
    """`depth_for`, up to `deepest`, as a column."""
    need = 1 - (1 - TARGET) ** (1 / TREES)
    steps = [F.lit(math.cos(math.pi * (1 - need ** (1 / d)))) for d in range(1, deepest + 1)]
    return reduce(lambda n, step: n + (cosine >= step).cast("int"), steps, F.lit(0))


def _climb(k: int, norm: float):
    """Best k of one shard (tree, depth, ...) for each of its queries."""

    def run(key, queries, rows):
        base = key[1].as_py()
        found = {"query_id": [], "rep": [], "score": []}
        if queries.num_rows and rows.num_rows:
            code = rows["code"].to_numpy()
            order = np.argsort(code, kind="stable")
            code, v = code[order].view(np.uint64), _matrix(rows["v"])[order]
            reps = rows["id"].to_numpy()[order]
            qcode, q = queries["code"].to_numpy().view(np.uint64), _matrix(queries["v"])
            order = np.argsort(code, kind="stable")
            code, v, reps = code[order], v[order], reps[order]
            lengths = np.linalg.norm(q, axis=1) * norm
            for i, query_id in enumerate(queries["id"].to_pylist()):
                low, high, scores = _ascend(code, v, qcode[i], q[i], lengths[i], k, base)
                scores = scores[low:high]
                few = np.arange(high - low)
                if len(few) > k:  # all that equal the k-th stay
                    few = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
                found["query_id"] += [query_id] * len(few)
                found["rep"].append(reps[low + few])
                found["score"].append(scores[few])
        flat = lambda parts, t: np.concatenate(parts) if parts else np.zeros(0, t)
        return pa.table(
            {
                "query_id": pa.array(found["query_id"], pa.int64()),
                "rep": pa.array(flat(found["rep"], np.int64), pa.int64()),
                "score": pa.array(flat(found["score"], float), pa.float64()),
            }
        )

    return run


def _ascend(code, v, own, q, length, k, base):
    """The run of sorted vectors that a query has met when it may stop, and their scores."""
    place = int(np.searchsorted(code, own))
    near = [int(code[j]) ^ int(own) for j in (place - 1, place) if 0 <= j < len(code)]
    depth = 64 - min(near).bit_length()  # the longest prefix match
    scores = np.empty(len(code))
    low = high = place
    while True:
        mask = (1 << (64 - depth)) - 1
        first = int(np.searchsorted(code, np.uint64(int(own) & ~mask), "left"))
        last = int(np.searchsorted(code, np.uint64(int(own) | mask), "right"))
        if low == high:
            scores[first:last] = v[first:last] @ q
        else:
            if first < low:
                scores[first:low] = v[first:low] @ q
            if high < last:
                scores[high:last] = v[high:last] @ q
        low, high = first, last
        if depth <= base:
            return low, high, scores
        n = high - low
        if n >= k:
            kth = np.partition(scores[low:high], n - k)[n - k]
            if depth <= depth_for(kth / length if length else 0.0):
                return low, high, scores
        depth -= 1


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` its k nearest of `vectors`.

    Nearness is the inner product in double precision; ties go to the smaller id. A query's own
    id is left out. Vectors that are NULL, zero, or hold a NULL or a number that is not finite,
    and rows without id, take no part on either side. Ids are long; repeated ids count once.
    So do vectors of another width than most of `vectors` have (of two widths that are equally frequent the
    smaller counts). Other columns are ignored; empty tables give no rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = _clean(vectors, id_col, vec).withColumn("id", F.col("id").cast("long"))
    square = F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("square")
    widths = rows.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n"), square)
    facts = widths.orderBy(F.desc("n"), "width").first()
    if facts is None:
        return empty
    total, width, norm = facts["n"], facts["width"], math.sqrt(facts["square"])
    rows = rows.where(F.size("v") == width)

    # One row for equal vectors, with their k + 1 smallest ids, cut first in parts of bounded size.
    parts = max(1, total // 10_000)
    few = lambda ids: F.slice(F.sort_array(F.array_distinct(ids)), 1, k + 1)
    groups = (
        rows.groupBy("v", F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"))
        .agg(few(F.collect_set("id")).alias("ids"))
        .groupBy("v")
        .agg(few(F.flatten(F.collect_list("ids"))).alias("ids"))
    )
    reps = materialize(groups.select(F.element_at("ids", 1).alias("id"), "v", "ids"), "vectors")
    asked = _clean(queries, id_col, vec).withColumn("id", F.col("id").cast("long")).where(F.size("v") == width)
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    asked = materialize(asked.dropDuplicates(["id"]).withColumn("length", F.sqrt(square) * norm), "queries")
    base = _base_depth(reps, asked, total, k)
    directions = spark.sparkContext.broadcast(_projections(width + 1))

    def coded(own_norm):
        def run(batches):
            for batch in batches:
                v = _matrix(batch["v"])
                c = codes(_longer(v, own_norm), directions.value).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * TREES, pa.int32()), pa.array(c.ravel()))
                yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], lists], names=["id", "v", "codes"])

        return run

    schema = "id long, v array<double>, codes array<long>"
    prefix = F.when(F.col("depth") > 0, F.expr("shiftrightunsigned(code, 64 - depth)")).otherwise(0)

    def shards(df, own_norm):
        one = df.select("id", "v").mapInArrow(coded(own_norm), schema)
        return one.select("id", "v", F.posexplode("codes").alias("tree", "code"))

    indexed = shards(reps, norm)
    left, done = asked.withColumn("depth", F.lit(base)), []
    while True:  # a query's depth falls with each round
        depths = sorted(r["depth"] for r in left.select("depth").distinct().collect())  # at most 21 numbers
        if not depths:
            break
        looked = shards(left, None).join(left.select("id", "depth"), "id")
        level = F.explode(F.array(*map(F.lit, depths)))
        met = materialize(_round(indexed.withColumn("depth", level), looked, prefix, k, norm), "met")
        got = met.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
        depth, enough = F.col("depth"), F.coalesce(F.col("n") > k, F.lit(False))
        wanted = _own_depth(F.when(F.col("length") > 0, F.col("kth") / F.col("length")).otherwise(0.0), base)
        later = F.when(enough, F.least(depth, wanted)).otherwise(F.floor(depth / 2).cast("int"))
        state = materialize(left.join(got, "id", "left").withColumn("later", later), "rounds")
        settled = state.where(F.col("later") == depth).select(F.col("id").alias("query_id"))
        done.append(met.join(settled, "query_id", "left_semi"))
        left = state.where(F.col("later") < depth).select("id", "v", "length", F.col("later").alias("depth"))
    if not done:
        return empty
    expanded = reduce(DataFrame.unionByName, done).join(reps.select(F.col("id").alias("rep"), "ids"), "rep").select(
        "query_id", "score", F.explode("ids").alias("vec_id")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = expanded.where("vec_id <> query_id").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _round(indexed: DataFrame, looked: DataFrame, prefix, k: int, norm: float) -> DataFrame:
    """(query_id, rep, score): the best k + 1, and all that equal the last, of what queries meet at their depth."""
    # At depth 0 each tree is one shard of all vectors.
    once = (F.col("depth") > 0) | (F.col("tree") == 0)
    indexed, looked = (df.where(once).withColumn("prefix", prefix) for df in (indexed, looked))
    keys = ["tree", "depth", "prefix"]
    # How many tasks a shard's vectors, and its queries, are dealt out to: small tables of at most
    # TREES * 2**base rows.
    cuts = indexed.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("v_cuts"))
    cuts = cuts.join(
        looked.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("q_cuts")), keys
    )
    cuts = materialize(cuts, "shard-sizes")
    spread = lambda cut: F.pmod(F.xxhash64("id"), F.col(cut)).cast("int")
    all_of = lambda cut: F.explode(F.sequence(F.lit(0), F.col(cut) - 1))
    left = looked.join(cuts, keys).withColumn("q_cut", spread("q_cuts")).withColumn("v_cut", all_of("v_cuts"))
    right = indexed.join(cuts, keys).withColumn("v_cut", spread("v_cuts")).withColumn("q_cut", all_of("q_cuts"))
    by = [*keys, "v_cut", "q_cut"]
    columns = [*by, "id", "code", "v"]
    met = (
        left.select(*columns)
        .groupBy(*by)
        .cogroup(right.select(*columns).groupBy(*by))
        .applyInArrow(_climb(k + 1, norm), "query_id long, rep long, score double")
    )
    met = met.groupBy("query_id", "rep").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"))
    return met.withColumn("place", F.rank().over(order)).where(F.col("place") <= k + 1).drop("place")
