"""Encoder queries use all cores, however the rows lie in files and row groups."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from vecloom.session import spread

N = 960


def _numbered(df, text_col, model, out_col="embedding", batch_size=32, partitions=None):
    """In the place of an encoder: vectors as wide as the number of the task that made them."""
    df = df.repartition(partitions) if partitions else df
    return df.withColumn(out_col, F.array_repeat(F.lit(1.0).cast("float"), F.spark_partition_id() + 1))


@pytest.fixture
def one_group(spark, tmp_path, monkeypatch):
    roles = pa.array([("user", "assistant")[i % 2] for i in range(N)])
    texts = pa.array([f"text {i} " + "word " * (i % 50) for i in range(N)])
    ids = pa.array([i // 4 for i in range(N)], pa.int64())
    turns = pa.array([i % 4 for i in range(N)], pa.int64())
    table = pa.table({"conv_id": ids, "turn": turns, "role": roles, "text": texts})
    pq.write_table(table, tmp_path / "conversations.parquet", row_group_size=N)
    for key, value in (("spark.sql.files.maxPartitionBytes", "1k"), ("spark.sql.files.openCostInBytes", "1")):
        old = spark.conf.get(key)
        spark.conf.set(key, value)
        request_end.append((spark, key, old))
    assert spark.read.parquet(str(tmp_path / "conversations.parquet")).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    monkeypatch.setattr(contract, "embed_column", _numbered)
    monkeypatch.setattr(contract, "_model", lambda *_: None)
    monkeypatch.setattr(contract, "route_requests", lambda requests, models: _numbered(requests, "text", None))
    yield str(tmp_path)
    while request_end:
        session, key, old = request_end.pop()
        session.conf.set(key, old)


request_end: list = []


@pytest.mark.parametrize("name", ["e1_embed", "e2_embed_jina", "t2_route_requests"])
def test_rows_are_even_over_four_tasks_a_core(spark, one_group, name):
    tasks = getattr(contract, name)(spark, one_group).groupBy("width").count().collect()
    cores = spark.sparkContext.defaultParallelism
    assert sum(r["count"] for r in tasks) == N
    assert len(tasks) == 4 * cores
    assert max(r["count"] for r in tasks) <= 2 * N / len(tasks)


def test_two_ways_of_dealing_differ_and_grow_with_the_cores(spark, one_group, monkeypatch):
    seen = []

    def counted(df, *args, **named):
        out = _numbered(df, *args, **named)
        seen.append(out.select(F.spark_partition_id()).distinct().count())
        return out

    monkeypatch.setattr(contract, "embed_column", counted)
    assert contract.e3_batch_invariance(spark, one_group).count() == N
    cores = spark.sparkContext.defaultParallelism
    assert seen == [4 * cores, 4 * cores - 3]


def test_splits_without_rows_do_not_count(spark, one_group):
    rows = spread(spark.read.parquet(f"{one_group}/conversations.parquet"))
    assert rows.select(F.spark_partition_id()).distinct().count() == spark.sparkContext.defaultParallelism
    assert rows.count() == N
    even = spark.range(0, N, numPartitions=2 * spark.sparkContext.defaultParallelism)
    assert spread(even) is even
