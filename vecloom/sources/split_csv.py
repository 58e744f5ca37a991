"""CSV with newlines in quoted fields, read by many tasks from one file.

A file is read as lines by byte ranges. A line begins a record if the quotes before it in the file are
even in number, which a sum over the ranges before and a running count within the range tell. So a first
pass counts quotes for each range, and a second cuts each range into records. What a range has of
a record that goes on in the next one, or came from the one before, is put together
afterwards: two short pieces a range at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vecloom.session import ship_package

BROADCAST_RANGES = 200_000  # (file, start, parity) rows sent to every executor
WHOLE, HEAD, MIDDLE, TAIL = range(4)
_RECORDS = "file string, start long, kind int, first boolean, record string"


class _Range:
    """The records of one byte range, line by line."""

    def __init__(self, file: str, start: int, opened: bool):
        self.file, self.start = file, start
        self.open, self.lines = opened, []
        self.began_before = opened  # the record in hand began in an earlier range
        self.first = start == 0

    def add(self, line: str, odd: bool):
        """The record that ends with this line, if one does: (kind, first, text)."""
        self.lines.append(line)
        self.open ^= odd
        return None if self.open else self._done(HEAD if self.began_before else WHOLE)

    def end(self):
        """What is left open at the end of the range."""
        return self._done(MIDDLE if self.began_before else TAIL) if self.lines else None

    def _done(self, kind: int):
        out = (kind, self.first, "\n".join(self.lines))
        self.lines, self.began_before, self.first = [], False, False
        return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in file order, range after range, as records and pieces of records."""
    current, found = None, []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*found, strict=True))
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        names = ["file", "start", "kind", "first", "record"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for rows in batches:
        odd = pc.equal(pc.bit_wise_and(pc.count_substring(rows["value"], '"'), 1), 1)
        columns = (rows[c].to_pylist() for c in ("file", "start", "opened", "value"))
        for file, start, opened, line, is_odd in zip(*columns, odd.to_pylist(), strict=True):
            if current is None or (current.file, current.start) != (file, start):
                if current is not None and (rest := current.end()):
                    found.append((current.file, current.start, *rest))
                current = _Range(file, start, opened)
            if record := current.add(line, is_odd):
                found.append((file, start, *record))
        if found:
            yield batch()
            found = []
    if current is not None and (rest := current.end()):
        found.append((current.file, current.start, *rest))
        yield batch()


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(first, record): every record of the files, `first` for the first one of each file.

    Fields hold newlines and doubled quotes only between quotes; a quote elsewhere is not CSV and
    would join records. Lines end in newline, with or without a carriage return before it.
    """
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("parity"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("parity").over(before) % 2 == 1, F.lit(False))
    ranges = counted.select("file", "start", opened.alias("opened"))
    if ranges.count() <= BROADCAST_RANGES:
        # The join then leaves the lines in the order of the file.
        placed = lines.join(F.broadcast(ranges), ["file", "start"])
    else:
        at = F.monotonically_increasing_id()
        placed = lines.withColumn("at", at).join(ranges, ["file", "start"]).sortWithinPartitions("file", "start", "at")
    pieces = placed.select("file", "start", "opened", "value").mapInArrow(_cut, _RECORDS)
    whole = pieces.where(F.col("kind") == WHOLE)
    # A record over several ranges is a tail, any number of middles, and a head.
    order = Window.partitionBy("file").orderBy("start", "kind")
    parted = pieces.where(F.col("kind") != WHOLE).withColumn("n", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = parted.groupBy("file", "n").agg(
        F.max("first").alias("first"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "record"))), lambda p: p["record"]), "\n").alias(
            "record"
        ),
    )
    return whole.select("first", "record").unionByName(joined.select("first", "record"))


def read_split_csv(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """CSV files with a header as `schema`, each file read by as many tasks as it has byte ranges.

    The size of a range is `spark.sql.files.maxPartitionBytes`. Empty lines are left out; a
    record with too few fields has NULLs. Files must have the columns of the schema, in order.
    """
    bare = F.regexp_replace("record", "\r$", "")
    records = csv_records(spark, path).where(~F.col("first")).select(bare.alias("record")).where("record <> ''")
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    # A mark that no text holds stands for empty fields without quotes, so "" stays an empty text.
    options = {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1", "nullValue": "\u0000"}
    parsed = F.from_csv("record", F.lit(ddl), options)
    return records.select(parsed.alias("r")).select("r.*")
