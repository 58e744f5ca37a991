"""One CSV file read by many tasks, cut anywhere: in fields, in quotes, and in records of many ranges."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from vecloom.sources.chunks import read_chunks, write_chunks
from vecloom.sources.split_csv import csv_records

SCHEMA = "id bigint, text string, note string"


def rows_of(n, seed):
    rng = random.Random(seed)
    parts = ["plain", 'say "hi"', "two\nlines", '"', "\n\n", ",", '",\n"', "é", "'", " "]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
    return [(i, text(), text() if i % 3 else None) for i in range(n)]


@pytest.mark.parametrize("size", [60, 500, 1 << 27])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_file_cut_anywhere(spark, tmp_path, size, end):
    rows = rows_of(150, size)
    rows[70] = (70, "long\n" * 300, 'over "many"\n ranges')
    path = tmp_path / "one.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator=end)
        writer.writerow(["id", "text", "note"])
        writer.writerows(rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        if size == 500:
            tasks = spark.read.text(str(path)).select("_metadata.file_block_start").distinct().count()
            assert tasks >= 8
        found = read_chunks(spark, str(path), schema=SCHEMA).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, found), key=lambda r: r[0]) == rows


def test_several_files_each_with_a_header(spark, tmp_path):
    rows = [(i, t, n or "") for i, t, n in rows_of(90, 5)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    write_chunks(table, str(tmp_path / "csv"))
    assert csv_records(spark, str(tmp_path / "csv")).where("first").count() == 3
    found = read_chunks(spark, str(tmp_path / "csv"), schema=SCHEMA).collect()
    assert sorted(map(tuple, found)) == sorted(rows)


def test_empty_lines_short_records_and_an_open_quote(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('id,text,note\n\n1,a\n2,"x\n\ny",n\n\n3,"never closed\n4,b,c')
    found = {r.id: r for r in read_chunks(spark, str(tmp_path / "odd.csv"), schema=SCHEMA).collect()}
    assert tuple(found[1]) == (1, "a", None) and tuple(found[2]) == (2, "x\n\ny", "n") and set(found) == {1, 2, 3}
    (tmp_path / "none.csv").write_text("id,text,note\n")
    assert read_chunks(spark, str(tmp_path / "none.csv"), schema=SCHEMA).count() == 0


def test_missing_text_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,b\n")
    with pytest.raises(ValueError, match="no column"):
        read_chunks(spark, str(tmp_path / "a.csv"), text_col="body", schema=SCHEMA)


def test_split_reading_gathers_no_lines(spark, tmp_path):
    write_chunks(spark.range(9).select(F.col("id"), F.lit("x").alias("text")), str(tmp_path / "c"))
    plan = read_chunks(spark, str(tmp_path / "c"), schema="id bigint, text string")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Cartesian" not in plan
