"""Each text of a table through an encoder once, in tasks of even cost (E-3, E-5).

Encoders are bound by arithmetic, so what counts is how many texts they see and how evenly tasks
are filled. Copies are found over the whole table, not only in a batch; distinct texts are dealt out by
the running sum of their costs in order of cost, so that tasks cost about the same and texts of
equal length, which an encoder runs without padding, come one after another.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecloom.session import materialize

HOT_SHARE = 1000  # a text with more than 1 / HOT_SHARE of all rows is hot; there are fewer than that
_STEPS = 64  # cost classes for each power of two


def _free(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _text_key(text_col: str) -> Column:
    """32 bytes in the place of a text of any length."""
    return F.unhex(F.sha2(F.col(text_col), 256))


def place_by_cost(texts: DataFrame, cost: Column, partitions: int) -> DataFrame:
    """`texts`, a stored table, dealt out to `partitions` tasks of about equal cost, each in order of cost.

    Costs (1 at least) are summed in classes of nearly equal cost, of which there are at most a few
    thousand however many texts there are. A class takes its stretch of the running sum, and
    a text its place there by its hash; tasks are equal cuts of the whole. Nothing is sorted globally.
    """
    size, part = _free(texts, "_cost"), _free(texts, "_part")
    sized = texts.withColumn(size, F.greatest(cost.cast("double"), F.lit(1.0)))
    kind = F.floor(F.log2(size) * _STEPS)
    classes = sized.groupBy(kind.alias("_class")).agg(F.sum(size).alias("_own"))
    before = Window.orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select(
        "_class", "_own", F.coalesce(F.sum("_own").over(before), F.lit(0.0)).alias("_before"),
        F.sum("_own").over(Window.partitionBy(F.lit(1))).alias("_total"),
    )
    share = F.pmod(F.xxhash64(*texts.columns), F.lit(1 << 31)) / float(1 << 31)
    place = (F.col("_before") + share * F.col("_own")) / F.col("_total") * partitions
    dealt = sized.join(F.broadcast(classes), kind == F.col("_class"))
    dealt = dealt.withColumn(part, F.least(F.floor(place), F.lit(partitions - 1)).cast("int"))
    dealt = dealt.select(*texts.columns, size, part).repartitionById(partitions, F.col(part))
    return dealt.sortWithinPartitions(size).select(*texts.columns)


def embed_distinct(
    df: DataFrame,
    text_col: str,
    encode: Callable[[DataFrame, str, str], DataFrame],
    out_col: str = "embedding",
    cost: Callable[[str], Column] = F.length,
    partitions: int | None = None,
) -> DataFrame:
    """`df` with the vectors of `text_col` added, each different text encoded once.

    `encode(df, text_col, out_col)` adds vectors, for example `embed_column` with a model or `embed_hash`.
    `cost` estimates what a text costs it; by default that is its length. `df` should be a
    stored table, as it is read three times, or a dear one's vectors can be joined by a key instead.
    NULL text gives a NULL vector and meets no encoder; all rows and columns stay. An `out_col` that is
    there already is an error.

    Copies are counted before they are shuffled. Vectors of hot texts are joined by broadcast (fewer than
    `HOT_SHARE` of them can be hot), as are rows without a text, so no key of the
    shuffled join has more than 1 / `HOT_SHARE` of the rows.
    """
    if out_col.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {out_col} exists already")
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = _free(df, "_text_key")
    texts = df.select(_text_key(text_col).alias("key"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    counted = materialize(texts.groupBy("key", "text").agg(F.count(F.lit(1)).alias("copies")), "texts")
    total = counted.agg(F.sum("copies")).first()[0] or 0
    placed = place_by_cost(counted, cost("text"), partitions)
    made = encode(placed, "text", "vector").select("key", "copies", "vector")
    vectors = materialize(made, "text-vectors").withColumnsRenamed({"key": key, "vector": out_col})
    hot = F.col("copies") * HOT_SHARE > total
    frequent = F.broadcast(vectors.where(hot).drop("copies"))
    rows = df.withColumn(key, _text_key(text_col))
    columns = [F.col(f"`{c}`") for c in (*df.columns, out_col)]
    without_text = rows.where(F.col(key).isNull()).withColumn(out_col, F.lit(None).cast(made.schema["vector"].dataType))
    of_frequent = rows.join(frequent, key)
    rest = rows.where(F.col(key).isNotNull()).join(frequent.select(key), key, "left_anti")
    of_rest = rest.join(vectors.where(~hot).drop("copies"), key)
    return of_rest.select(*columns).unionByName(of_frequent.select(*columns)).unionByName(without_text.select(*columns))
