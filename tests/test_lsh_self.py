"""The self-join against brute force, with many equal and many near vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_search import frame, make

from vecloom.operators.lsh import copy_groups, lsh_join
from vecloom.operators.lsh_self import lsh_self_join, pair_recall
from vecloom.session import materialize

SHAPE = {"bucket_length": 3.0, "tables": 6, "width": 1}


def exact(rows, max_dist):
    good = [(i, np.array(v)) for i, v in rows if v and np.isfinite(v).all()]
    return {(i, j): d for i, v in good for j, w in good if i < j and (d := float(np.linalg.norm(v - w))) <= max_dist}


@pytest.mark.parametrize("block_rows", [2048, 20])
def test_expanded_self_join_equals_join_of_two_copies(spark, block_rows):
    rows = make(240, 41)
    table = materialize(frame(spark, rows, "x"), "rows")
    two = lsh_join(table, table.withColumnRenamed("x", "y"), 1.2, "x", "y", **SHAPE).where("x < y").collect()
    one = lsh_self_join(table, 1.2, "x", "y", block_rows=block_rows, expand_copies=True, **SHAPE).collect()
    assert sorted((r.x, r.y) for r in one) == sorted((r.x, r.y) for r in two)
    true = exact(rows, 1.2)
    assert all(r.distance == pytest.approx(true[r.x, r.y]) for r in one) and len(one) > 0.95 * len(true)


def test_compact_pairs_and_half_the_comparisons(spark):
    rows = make(240, 42)
    table, stats, double = materialize(frame(spark, rows, "x"), "rows"), {}, {}
    compact = lsh_self_join(table, 1.2, "x", "y", stats=stats, **SHAPE).collect()
    firsts = {r.rep for r in copy_groups(table, "x").select("rep").distinct().collect()}
    true = {p for p in exact(rows, 1.2) if set(p) <= firsts}
    found = {(r.x, r.y) for r in compact}
    assert len(found) == len(compact) and found <= true and len(found) > 0.95 * len(true)
    distinct = copy_groups(table, "x").where("x = rep").join(table, "x").select("x", "embedding")
    distinct = materialize(distinct, "distinct")
    lsh_join(distinct, distinct.withColumnRenamed("x", "y"), 1.2, "x", "y", stats=double, broadcast_bytes=0, **SHAPE)
    n = distinct.where("embedding IS NOT NULL").count() - 1  # one holds NaN
    assert 2 * stats["candidates"] + n * SHAPE["tables"] == double["candidates"]


def test_equal_and_near_vectors_in_bounded_tasks(spark):
    """30 percent are one vector, 30 percent lie close to another."""
    rng = np.random.default_rng(43)
    center, rows = rng.standard_normal(16), []
    for i in range(2000):
        kind = i % 10
        v = np.ones(16) if kind < 3 else center + rng.standard_normal(16) * 0.15 if kind < 6 else rng.standard_normal(16) * 3
        rows.append((i, [float(x) for x in v]))
    table, plain, split = materialize(frame(spark, rows, "x"), "rows"), {}, {}
    shape = {"bucket_length": 6.0, "tables": 12, "width": 2, "block_rows": 100}
    whole = lsh_self_join(table, 1.0, "x", "y", stats=plain, **shape)
    pieces = lsh_self_join(table, 1.0, "x", "y", stats=split, max_bucket=200, levels=3, **shape)
    assert split["levels"] == 3 and split["candidates"] < plain["candidates"]
    ratio = split["candidates"] / split["pairs"]
    found = {(r.x, r.y) for r in pieces.collect()}
    firsts = {0, *(i for i in range(2000) if i % 10 >= 3)}
    true = {p for p in exact(rows, 1.0) if set(p) <= firsts}
    assert found <= true and {(r.x, r.y) for r in whole.collect()} <= true
    assert len(found) >= 0.9 * len(true), (len(found), len(true), ratio)
    sample = table.where("x % 20 = 3")
    measured = pair_recall(pieces, table, 1.0, "x", "y", "embedding", sample)
    sampled = [p for p in true if any(i % 20 == 3 for i in p)]
    assert measured == pytest.approx(sum(p in found for p in sampled) / len(sampled))
    # No piece holds more than two blocks of rows, by hash of about 100 each.
    from vecloom.operators import lsh_self

    placed = []
    original = lsh_self._placed
    lsh_self._placed = lambda *a: placed.append(original(*a)) or placed[0]
    try:
        lsh_self_join(table, 1.0, "x", "y", **shape)
    finally:
        lsh_self._placed = original
    assert placed[0].groupBy("piece").count().agg(F.max("count")).first()[0] <= 300


def test_self_join_of_empty_and_single_tables(spark):
    assert lsh_self_join(frame(spark, [], "x"), 1.0, "x", "y").collect() == []
    assert lsh_self_join(frame(spark, make(1, 44, odd=False), "x"), 1.0, "x", "y", expand_copies=True).collect() == []
    equal = frame(spark, [(i, [1.0, 2.0]) for i in range(4)], "x")
    assert lsh_self_join(equal, 1.0, "x", "y").collect() == []
    assert len(lsh_self_join(equal, 1.0, "x", "y", expand_copies=True).collect()) == 6
