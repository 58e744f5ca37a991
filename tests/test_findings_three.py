"""Findings of round three: queries on tables that are folders of files, in pieces and slices of bounded size."""

import inspect

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from vecloom.functions.arrow_vectors import text_slices
from vecloom.operators import cells, embed, hashing, lsh, scoring
from vecloom.operators.lsh import lsh_join
from vecloom.operators.lsh_self import lsh_self_join
from vecloom.operators.vocabulary import with_word_ids, word_vocabulary, words_of


def test_stream_reads_a_table_of_many_files(spark, tmp_path):
    talk = spark.createDataFrame(
        [(i, 0, "user", f"word {i}") for i in range(6)], "conv_id long, turn int, role string, text string"
    )
    talk.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    talk.write.parquet(str(tmp_path / "documents.parquet"))  # another table beside it is not read
    found = contract.t1_embed_stream(spark, str(tmp_path)).collect()
    assert sorted({r.conv_id for r in found}) == list(range(6)) and len(found) == 12


def test_slices_of_texts_are_bounded_and_whole():
    texts = pa.array(["ab", None, "c" * 50, "", "dd", "e" * 9, "f"])
    parts = list(text_slices(texts, 10, 3))
    assert pa.concat_arrays(parts).equals(texts) and max(map(len, parts)) <= 3
    assert all(len(p) == 1 or sum(len(t or "") for t in p.to_pylist()) <= 10 for p in parts)
    assert list(text_slices(pa.array([], pa.string()), 10)) == []


def test_tokenizing_and_hashing_see_few_texts_at_once(minilm, monkeypatch):
    texts = pa.array([f"hello world {i} " * (i % 40) for i in range(400)] + [None, ""])
    whole = hashing._hash_column(texts, 16)
    seen = []
    plain = hashing._hash_texts
    monkeypatch.setattr(hashing, "_TEXT_BYTES", 2000)
    monkeypatch.setattr(hashing, "_hash_texts", lambda part, dim: seen.append(part.nbytes) or plain(part, dim))
    assert str(hashing._hash_column(texts, 16).to_pylist()) == str(whole.to_pylist()) and len(seen) > 20

    tokenized = []
    ids = embed.token_ids
    monkeypatch.setattr(embed, "_TEXT_BYTES", 2000)
    monkeypatch.setattr(embed, "token_ids", lambda ref, rows: tokenized.append(sum(map(len, rows))) or ids(ref, rows))
    got = embed._ids_of(minilm, texts)
    assert got.to_pylist() == [None if t is None else ids(minilm, [t])[0] for t in texts.to_pylist()]
    assert len(tokenized) > 50 and max(tokenized) <= 2000


def _dense(spark, n):
    """Vectors that are all in one bucket of the only table."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((n, 4)))]
    return spark.createDataFrame(rows, "id long, embedding array<double>")


@pytest.mark.parametrize("n", [3, 300])
def test_rows_of_a_large_bucket_are_shuffled_a_bounded_number_of_times(spark, tmp_path, monkeypatch, n):
    _dense(spark, n).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    one = {"tables": 1, "projections": (np.zeros((1, 4)), np.zeros(1)), "block_rows": 2}
    count = spark.range(1).select(
        lsh.block_count(F.lit(n), 2, 4).alias("n"), lsh.block_count(F.lit(None).cast("long"), 2, 4).alias("none")
    ).first()
    assert count.n <= lsh.MOST_BLOCKS and count.none == 1
    v = [r.embedding for r in rows.orderBy("id").collect()]
    near = [(i, j) for i in range(n) for j in range(i + 1, n) if np.linalg.norm(np.subtract(v[i], v[j])) <= 2.0]
    for bytes_ in (lsh.BLOCK_BYTES, 160 * 20):  # blocks of 20 rows at most
        monkeypatch.setattr(lsh, "BLOCK_BYTES", bytes_)
        found = lsh_self_join(rows, 2.0, "id", "other", **one).collect()
        assert sorted((r.id, r.other) for r in found) == near
        both = lsh_join(rows, rows.withColumnRenamed("id", "other"), 2.0, "id", "other", broadcast_bytes=0, **one)
        assert sorted((r.id, r.other) for r in both.where("id < other").collect()) == near


def test_word_ids_follow_frequency_over_many_ranges(spark):
    texts = [(1, "b a, B c"), (2, "c b d"), (3, None), (4, "x-a")]
    table = spark.createDataFrame(texts, "id int, text string")
    vocabulary = word_vocabulary(table, "text", 4)
    assert {r.word: r.id for r in vocabulary.collect()} == {"b": 4, "a": 5, "c": 6, "d": 7, "x": 8}
    asked = spark.createDataFrame([(7, "C zzz b b"), (7, "..."), (None, None)], "id int, text string")
    rows = with_word_ids(asked.withColumn("words", words_of("text")), "words", vocabulary, "ids", 1).collect()
    assert sorted(str((r.id, r.ids)) for r in rows) == sorted(["(7, [6, 1, 4, 4])", "(7, None)", "(None, None)"])


def test_tokenize_query_gives_every_id(spark, tmp_path):
    spark.createDataFrame([(0, "two two one")], "conv_id long, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    documents = spark.createDataFrame([(1, "One, two! three"), (2, "")], "doc_id long, text string")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: (r.n_tokens, r.ids) for r in contract.e4_tokenize(spark, str(tmp_path)).collect()}
    assert found == {1: (5, "2 5 4 1 3"), 2: (2, "2 3")}


def test_cell_searches_bound_their_pieces():
    assert cells.PIECE_BYTES <= 16 << 20
    assert inspect.signature(cells.topk_cells).parameters["max_question_bytes"].default <= 16 << 20


@pytest.mark.parametrize("probes", [[[1, 2], None, [2], []], [None, [], None, None]])
def test_probes_of_a_block_are_arrays(probes):
    vectors = pa.array([[0.0], [1.0], [2.0], [3.0]])
    block = scoring.QuestionBlock.of(pa.array([0, 1, 2, 3]), vectors, probes)
    schema = pa.schema([("qid", pa.int64()), ("key", pa.int64()), ("distance", pa.float64())])
    batch = pa.RecordBatch.from_arrays([pa.array([10, 20]), pa.array([[0.0], [2.0]]), pa.array([1, 2])], ["k", "v", "cell"])
    found = [r for part in scoring.best_rows(iter([batch]), block, 5, schema) for r in part.to_pylist()]
    wanted = {(q, 10 * cell) for q, own in enumerate(probes) for cell in own or ()}
    assert {(r["qid"], r["key"]) for r in found} == wanted
