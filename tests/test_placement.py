"""Texts encoded once each, in tasks of even cost, against the encoder run on all rows."""

import pytest
from pyspark.sql import functions as F

from vecloom.operators.hashing import embed_hash
from vecloom.operators.placement import embed_distinct, place_by_cost

LONG = "word " * 40_000


def encoder(seen):
    def encode(df, text_col, out_col):
        seen.append(df)
        return embed_hash(df, text_col, out_col, 16)

    return encode


def plain(df):
    return sorted((r["id"] or 0, str(r["_text_key"]), r["text"] or "", str(r["embedding"])) for r in df.collect())


def rows(spark):
    texts = [None, "", " ", LONG, LONG, "é 中"] + ["the same text"] * 300 + [None] * 100 + [f"text {i} " * (i % 9) for i in range(200)]
    return spark.createDataFrame([(i // 2, t, "own") for i, t in enumerate(texts)], "id long, text string, _text_key string")


def test_equals_the_encoder_on_all_rows(spark):
    table, seen = rows(spark), []
    found = embed_distinct(table, "text", encoder(seen), partitions=5)
    assert found.columns == ["id", "text", "_text_key", "embedding"]
    assert plain(found) == plain(embed_hash(table, "text", dim=16))
    # Every different text met the encoder once, and NULL did not.
    assert seen[0].count() == table.where("text IS NOT NULL").select("text").distinct().count()
    assert found.where("text IS NULL AND embedding IS NOT NULL").count() == 0


def test_hot_texts_are_broadcast_and_others_joined(spark, monkeypatch):
    table = rows(spark)
    for share in (1, 3, 10**9):
        monkeypatch.setattr("vecloom.operators.placement.HOT_SHARE", share)
        assert plain(embed_distinct(table, "text", encoder([]), partitions=3)) == plain(embed_hash(table, "text", dim=16))


def test_tasks_cost_the_same_and_lengths_lie_together(spark):
    sizes = [1 + (i * i) % 500 for i in range(6000)]
    texts = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(sizes)], "id long, text string")
    placed = place_by_cost(texts, F.length("text"), 8)
    parts = placed.groupBy(F.spark_partition_id().alias("p")).agg(
        F.sum(F.length("text")).alias("cost"), F.min(F.length("text")).alias("low"), F.max(F.length("text")).alias("high")
    )
    found = parts.orderBy("low", "high").collect()
    share = sum(sizes) / 8
    assert len(found) == 8 and all(0.9 * share < r["cost"] < 1.1 * share for r in found)
    # Each task has a range of costs of its own, but for the classes that are cut between two.
    assert all(b["low"] >= a["high"] * 0.97 for a, b in zip(found, found[1:], strict=False))
    assert placed.count() == 6000 and placed.columns == ["id", "text"]


def test_one_very_long_text_does_not_move_the_others(spark):
    texts = spark.createDataFrame([(LONG,)] + [(f"{i:05d}" * 20,) for i in range(8000)], "text string")
    placed = place_by_cost(texts, F.length("text"), 5)
    sums = placed.groupBy(F.spark_partition_id()).agg(F.sum(F.length("text")).alias("n"), F.max(F.length("text")).alias("m"))
    costs = [r["n"] - (r["m"] if r["m"] == len(LONG) else 0) for r in sums.collect()]
    assert max(costs) < 1.1 * (len(LONG) + 800_000) / 5


def test_empty_tables_and_clashes(spark):
    table = rows(spark)
    assert embed_distinct(table.limit(0), "text", encoder([])).count() == 0
    only_null = table.where("text IS NULL")
    assert embed_distinct(only_null, "text", encoder([])).where("embedding IS NULL").count() == only_null.count()
    with pytest.raises(ValueError, match="exists already"):
        embed_distinct(table, "text", encoder([]), out_col="ID")
