"""CSV files of text chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from vecloom.sources.split_csv import read_split_csv


def read_chunks(
    spark: SparkSession,
    path: str | list[str],
    text_col: str = "text",
    schema: StructType | str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header; quoted fields may hold newlines and doubled quotes.

    With `schema`, files are read by many tasks each (`split_csv.read_split_csv`). Without it, types
    are inferred, and with `multi_line` one task reads one file; turn that off where no
    field holds a newline.
    """
    if schema is not None and multi_line:
        chunks = read_split_csv(spark, path, schema)
        if text_col not in chunks.columns:
            raise ValueError(f"no column {text_col!r} in {path}; found {', '.join(chunks.columns)}")
        return chunks
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
    chunks = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    if text_col not in chunks.columns:
        raise ValueError(f"no column {text_col!r} in {path}; found {', '.join(chunks.columns)}")
    return chunks


def write_chunks(df: DataFrame, path: str) -> None:
    """CSV that `read_chunks` reads back unchanged, empty strings and outer blanks included."""
    (
        df.write.option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
