"""Texts whose hash vector is NaN: no token at all, or tokens that cancel out."""

from hashlib import md5

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as contract

DIM = contract.DIM


def _cancelling() -> str:
    """Two words of one bucket with opposite signs."""
    seen: dict = {}
    for number in range(100_000):
        word = f"w{number}"
        h = int(md5(word.encode()).hexdigest()[:8], 16)
        other = seen.setdefault((h % DIM, (h // DIM) % 2 ^ 1), None)
        if other:
            return f"{word} {other}"
        seen[h % DIM, (h // DIM) % 2] = word
    raise AssertionError


def test_star_plus_of_texts_without_a_vector_equals_its_sql(spark, tmp_path):
    texts = ["hello world", "", "!!! ... ---", _cancelling(), "hello hello", "the first year of the engine"]
    n = len(texts)
    table = {
        "doc_id": pa.array(range(n), pa.int64()),
        "text": texts,
        "lang": ["en"] * n,
        "source": ["web"] * n,
        "n_chars": pa.array([len(text) for text in texts], pa.int64()),
    }
    path = str(tmp_path / "documents.parquet")
    pq.write_table(pa.table(table), path)
    columns = ["doc_id", "text", "lang", "source", "n_chars", "signed_places", "largest", "embedded_text"]
    found = contract.p1_select_star_plus(spark, str(tmp_path)).select(*columns).collect()
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}')")
        expected = db.execute(f"SELECT {', '.join(columns)} FROM ({contract.oracle_sql()['p1_select_star_plus']})").fetchall()
    assert sorted(map(tuple, found)) == sorted(expected)
    assert [r["doc_id"] for r in sorted(found) if r["signed_places"] is None] == [1, 2, 3]
