"""Inline tables and stored vector tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions.vectors import to_vector


def inline_texts(spark: SparkSession, name: str, column: str, texts: Sequence[str]) -> DataFrame:
    """A temporary view `name` with the texts in one column; quotes in them need no care."""
    table = spark.createDataFrame([(text,) for text in texts], f"`{column}` string")
    table.createOrReplaceTempView(name)
    return table


def build_vector_table(
    df: DataFrame,
    encode: Callable[[DataFrame], DataFrame],
    path: str,
    dim: int,
    vec: str = "embedding",
    mode: str = "errorifexists",
) -> DataFrame:
    """Create table as select: `df` with its vectors, width-checked, as parquet at `path`.

    `encode` adds the column `vec`. Everything after reads the stored table, so the encoder
    runs once per row however often the table is searched or a later stage is repeated.
    """
    encoded = encode(df)
    table = encoded.withColumn(vec, to_vector(vec, dim))
    table.write.mode(mode).parquet(path)
    return vector_table(df.sparkSession, path)


def vector_table(spark: SparkSession, path: str) -> DataFrame:
    """Scan a stored vector table; unused columns and pushed-down filters stay in the files."""
    return spark.read.parquet(path)


def save_vector_table(
    df: DataFrame, encode: Callable[[DataFrame], DataFrame], name: str, dim: int, vec: str = "embedding"
) -> DataFrame:
    """As `build_vector_table`, into a catalog table."""
    encode(df).withColumn(vec, to_vector(vec, dim)).write.saveAsTable(name)
    return df.sparkSession.table(name)


def with_row_key(df: DataFrame, key: str) -> DataFrame:
    """A key for rows that have none. Fixed only once the rows are written."""
    return df.withColumn(key, F.monotonically_increasing_id())
