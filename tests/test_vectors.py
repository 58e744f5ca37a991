import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecloom import register_vector_functions
from vecloom.functions.vectors import array_distance, l2_normalize, mean_pool, to_vector, valid_text, vector_width
from vecloom.operators.pooling import mean_pool_groups

PAIR = "a array<double>, b array<double>"


def test_distance_and_null(spark):
    rows = spark.createDataFrame([([0.0, 0.0], [3.0, 4.0]), (None, [1.0, 1.0]), ([1.0, 1.0], None)], PAIR)
    assert [r[0] for r in rows.select(array_distance("a", "b")).collect()] == [5.0, None, None]


@pytest.mark.parametrize("bad", [([1.0], [1.0, 2.0]), ([1.0, None], [1.0, 2.0])])
def test_distance_errors(spark, bad):
    with pytest.raises(Exception, match="array_distance"):
        spark.createDataFrame([bad], PAIR).select(array_distance("a", "b")).collect()


def test_distance_of_nan_is_nan(spark):
    rows = spark.createDataFrame([([math.nan, 0.0], [1.0, 1.0])], PAIR)
    assert math.isnan(rows.select(array_distance("a", "b")).first()[0])


def test_sql_functions_equal_expressions(spark):
    register_vector_functions(spark)
    rows = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0]), (None, [1.0, 1.0]), ([0.0, 0.0], [0.5, 0.25])], PAIR)
    rows.createOrReplaceTempView("pairs")
    sql = spark.sql("SELECT array_distance(a, b) d, to_vector(a, 2) v, l2_normalize(b) u FROM pairs").collect()
    own = rows.select(array_distance("a", "b"), to_vector("a", 2), l2_normalize("b")).collect()
    assert [tuple(r) for r in sql] == [tuple(r) for r in own]


def test_sql_distance_of_literals_of_any_number_type(spark):
    register_vector_functions(spark)
    assert spark.sql("SELECT array_distance(array(1.0, 2), array(4, 6))").first()[0] == 5.0


def test_to_vector_checks_the_width(spark):
    rows = spark.createDataFrame([([1.0, 2.0],), (None,)], "a array<double>")
    assert [r[0] for r in rows.select(to_vector("a", 2)).collect()] == [[1.0, 2.0], None]
    with pytest.raises(Exception, match="cannot cast a list with length 2"):
        rows.select(to_vector("a", 3)).collect()
    assert rows.select(to_vector("a", 2).alias("v")).schema["v"].dataType.elementType.typeName() == "float"


def test_width(spark):
    rows = spark.createDataFrame([([1.0, 2.0],), ([],), (None,)], "a array<double>")
    assert [r[0] for r in rows.select(vector_width("a")).collect()] == [2, 0, None]


def test_normalize_zero_is_nan(spark):
    rows = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,)], "a array<double>")
    unit, zero, null = (r[0] for r in rows.select(l2_normalize("a")).collect())
    assert unit == pytest.approx([0.6, 0.8])
    assert all(math.isnan(x) for x in zero) and null is None


def test_mean_pool_of_a_row(spark):
    rows = spark.createDataFrame(
        [([[1.0, 2.0], [3.0, 4.0], [9.0, 9.0]], [1, 1, 0]), ([[1.0, 2.0]], [0])], "v array<array<double>>, m array<int>"
    )
    assert [r[0] for r in rows.select(mean_pool("v", "m")).collect()] == [[2.0, 3.0], [0.0, 0.0]]


def test_mean_pool_of_groups_with_a_hot_key_and_null_keys(spark):
    rng = np.random.default_rng(1)
    keys = [None if i % 7 == 0 else ("hot" if i % 3 else f"k{i}") for i in range(900)]
    vectors, mask = rng.standard_normal((900, 3)), rng.integers(0, 2, 900)
    rows = spark.createDataFrame(
        [(k, [float(x) for x in v], int(m)) for k, v, m in zip(keys, vectors, mask)], "k string, v array<double>, m int"
    )
    found = {r["k"]: r["embedding"] for r in mean_pool_groups(rows.repartition(5), "k", "v", "m").collect()}
    assert set(found) == set(keys)
    for key in set(keys):
        own = np.array([k == key for k in keys])
        expected = (vectors[own] * mask[own, None]).sum(0) / max(mask[own].sum(), 1e-8)
        assert found[key] == pytest.approx(list(expected), abs=1e-6)


def test_valid_text(spark):
    rows = spark.createDataFrame([(bytearray(b"a\xffb"),), (bytearray("é🙂".encode()),), (None,)], "b binary")
    assert [r[0] for r in rows.select(valid_text("b")).collect()] == ["a�b", "é🙂", None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.floats(-100, 100, width=32), min_size=4, max_size=4), min_size=2, max_size=8))
def test_distance_of_unit_vectors_follows_from_the_dot_product(spark, vectors):
    vectors = [v for v in vectors if np.linalg.norm(v) > 1e-3]
    if not vectors:
        return
    rows = spark.createDataFrame([(v, vectors[0]) for v in vectors], PAIR)
    unit = rows.select(l2_normalize("a").alias("a"), l2_normalize("b").alias("b"))
    for r in unit.select(array_distance("a", "b").alias("d"), "a", "b").collect():
        assert r["d"] ** 2 == pytest.approx(2 - 2 * float(np.dot(r["a"], r["b"])), abs=1e-5)
        assert np.linalg.norm(r["a"]) == pytest.approx(1, abs=1e-5)


def test_normalize_reads_the_norm_once(spark):
    plan = spark.range(1).select(l2_normalize(F.array(F.lit(1.0), F.lit(2.0)))).columns[0]
    assert plan.lower().count("sqrt") == 1
