"""Word ids by frequency in a table, as joins: no word list goes through the driver or one task.

A vocabulary is a table (word, id). Where it is small Spark broadcasts it; else texts' words are
shuffled by word, and adaptive execution splits the frequent ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecloom.session import materialize

SEPARATORS = r"[^\p{L}\p{N}]+"


def words_of(text) -> Column:
    """Lower-case words of a text, in order; NULL for NULL."""
    return F.filter(F.split(F.lower(text), SEPARATORS), lambda word: word != "")


def word_vocabulary(df: DataFrame, text_col: str, first: int) -> DataFrame:
    """(word, id) of all words, numbered from `first` by falling frequency, then by word.

    Words are dealt out by ranges of that order, numbered in their range, and moved on by the sizes of the ranges before.
    """
    counted = df.select(F.explode(words_of(text_col)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("word")]
    ranged = materialize(counted, "words").repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("size"))  # one row a range
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("part", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    numbered = ranged.withColumn("place", place).join(F.broadcast(sizes), "part")
    return materialize(numbered.select("word", (F.col("before") + F.col("place") + (first - 1)).alias("id")), "vocabulary")


def with_word_ids(df: DataFrame, words_col: str, vocabulary: DataFrame, out_col: str, unknown: int) -> DataFrame:
    """`df` with the ids of the words of each row, in their order, in place of `words_col`; NULL where there are none."""
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "words-of-rows")
    words = rows.select("_row", F.posexplode(words_col).alias("pos", "word"))
    ids = words.join(vocabulary, "word", "left").withColumn("id", F.coalesce("id", F.lit(unknown)))
    placed = F.array_sort(F.collect_list(F.struct("pos", "id")))  # the words of one text
    own = ids.groupBy("_row").agg(F.transform(placed, lambda x: x["id"]).alias(out_col))
    return rows.drop(words_col).join(own, "_row", "left").drop("_row")
