"""CSV chunks, vector tables, JSON requests, retrieval and the streams."""

import hashlib
import json
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom import build_vector_table, embed_column, embed_hash, read_chunks, register, retrieve
from vecloom.operators.embed import embed_routed
from vecloom.session import materialize, scratch_path, shared_root
from vecloom.sources.chunks import write_chunks
from vecloom.sources.requests import accepted, parse_requests, rejected, respond
from vecloom.sources.tables import inline_texts, save_vector_table, vector_table
from vecloom.streaming.embed_stream import (
    embed_stream,
    encoder_for,
    request_stream,
    route_requests,
    unrouted_requests,
    write_stream,
)

ODD_TEXTS = ['a "quoted" word', "two\nlines", "comma, and ' quote", "", "  blanks  ", "é🙂", 'ends with "', "plain"]


def hash_vector(text, dim):
    vector = np.zeros(dim)
    for token in re.split(r"[\W_]+", text.lower()):
        if token:
            h = int(hashlib.md5(token.encode()).hexdigest()[:8], 16)
            vector[h % dim] += 1 if (h // dim) % 2 == 0 else -1
    with np.errstate(invalid="ignore"):
        return vector / np.linalg.norm(vector)


def test_hash_vectors_equal_a_loop(spark):
    texts = ["", "One two, two!", "Été zwölf über_alles 42", "?!", None, "Straße " * 50]
    rows = embed_hash(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "text", dim=16)
    for r in rows.collect():
        if r["text"] is None:
            assert r["embedding"] is None
        else:
            assert r["embedding"] == pytest.approx(list(hash_vector(r["text"], 16)), abs=1e-6, nan_ok=True)


def test_hash_of_a_text_without_tokens_is_nan(spark):
    rows = embed_hash(spark.createDataFrame([("!",)], "text string"), "text", dim=4)
    assert all(math.isnan(x) for x in rows.first()["embedding"])


def test_csv_round_trip(spark):
    rows = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "id int, text string")
    path = scratch_path(spark, "csv")
    write_chunks(rows, path)
    back = read_chunks(spark, path)
    assert dict(back.dtypes) == {"id": "int", "text": "string"}
    assert sorted((r["id"], r["text"] or "") for r in back.collect()) == list(enumerate(ODD_TEXTS))


def test_csv_written_by_hand(spark, tmp_path):
    (tmp_path / "chunks.csv").write_text('id,score,text\n1,0.5,"a ""b"" c\nd"\n2,,plain\n')
    rows = read_chunks(spark, str(tmp_path / "chunks.csv"))
    assert dict(rows.dtypes) == {"id": "int", "score": "double", "text": "string"}
    assert [tuple(r) for r in rows.collect()] == [(1, 0.5, 'a "b" c\nd'), (2, None, "plain")]
    with pytest.raises(ValueError, match="no column 'body'"):
        read_chunks(spark, str(tmp_path / "chunks.csv"), text_col="body")


def test_inline_texts(spark):
    inline_texts(spark, "questions", "random_questions", ["What's this?", 'a "b"'])
    assert [r[0] for r in spark.sql("SELECT random_questions FROM questions").collect()] == ["What's this?", 'a "b"']


def test_vector_table_is_written_once_and_pruned(spark):
    rows = spark.createDataFrame([(0, "a b", "x"), (1, "c", "y")], "id int, text string, lang string")
    table = build_vector_table(rows, lambda df: embed_hash(df, "text", dim=8), scratch_path(spark, "t"), 8)
    plan = table.where("lang = 'x'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "EqualTo(lang,x)" in plan and "embedding" not in plan
    assert table.count() == 2
    with pytest.raises(Exception, match="cannot cast a list with length 8"):
        build_vector_table(rows, lambda df: embed_hash(df, "text", dim=8), scratch_path(spark, "t"), 9)


def test_vector_table_in_the_catalog(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS vectors LOCATION '{tmp_path}/vectors'")
    rows = spark.createDataFrame([(0, "a b")], "id int, text string")
    save_vector_table(rows, lambda df: embed_hash(df, "text", dim=8), "vectors.chunks", 8)
    assert spark.table("vectors.chunks").count() == 1
    spark.sql("DROP TABLE vectors.chunks")


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_root(spark) == configured.rstrip("/")
    path = scratch_path(spark, "x")
    assert path.startswith(shared_root(spark)) and path != scratch_path(spark, "x")
    rows = materialize(spark.range(5), "five")
    assert rows.count() == 5 and "Range" not in rows._jdf.queryExecution().toString()


def test_requests_and_responses(spark):
    lines = [
        '{"text": "it\'s \\"fine\\"", "model": "embed"}',
        '{"text": "plain"}',
        '{"text": 5}',
        '{"body": "x"}',
        "{bad",
        "[1, 2]",
        None,
    ]
    parsed = parse_requests(spark.createDataFrame([(line,) for line in lines], "line string"), "line")
    good = {r["text"]: r["model"] for r in accepted(parsed).collect()}
    assert good == {'it\'s "fine"': "embed", "plain": None}
    reasons = {r["line"]: r["reject_reason"] for r in rejected(parsed).collect()}
    assert reasons == {
        '{"text": 5}': "missing_text",
        '{"body": "x"}': "missing_text",
        "{bad": "malformed_json",
        "[1, 2]": "malformed_json",
        None: "malformed_json",
    }
    answer = respond(embed_hash(accepted(parsed), "text", dim=8)).first()["response"]
    assert len(json.loads(answer)["embedded_text"]) == 8


@pytest.mark.parametrize("key", ["id", None])
def test_retrieve(spark, key):
    texts = ["the capital of france", "car engine work", "speed of light", "the capital of france", "a book plot"]
    path = scratch_path(spark, "csv")
    write_chunks(spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1), path)
    questions = spark.createDataFrame([(1, "What is the capital of France?"), (2, "speed?")], "qid int, question string")
    encode = lambda df, text, out: embed_hash(df, text, out, 64)
    found = retrieve(spark, path, questions, encode, 64, 3, key).collect()
    for qid, question in ((1, "What is the capital of France?"), (2, "speed?")):
        asked = hash_vector(question, 64)
        expected = sorted((round(float(np.linalg.norm(hash_vector(t, 64) - asked)), 5), i) for i, t in enumerate(texts))
        rows = sorted((r for r in found if r["qid"] == qid), key=lambda r: r["rank"])
        assert [r["text"] for r in rows] == [texts[i] for _, i in expected[:3]]
        assert [round(r["distance"], 5) for r in rows] == pytest.approx([d for d, _ in expected[:3]], abs=2e-5)


def test_retrieve_with_a_sentence_encoder(spark, minilm):
    path = scratch_path(spark, "csv")
    texts = ["hello world", "the speed of light", "the first book"]
    write_chunks(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), path)
    asked = spark.createDataFrame([(0, "the speed of light")], "qid int, question string")
    encode = lambda df, text, out: embed_column(df, text, minilm, out)
    found = retrieve(spark, path, asked, encode, 384, 1, "id").collect()
    assert [(r["text"], round(r["distance"], 4)) for r in found] == [("the speed of light", 0.0)]


def test_documented_sql_runs(spark, minilm, jina):
    register(spark, (minilm, jina))
    path = scratch_path(spark, "csv")
    texts = ["hello world", "the speed of light", "the first book"]
    write_chunks(spark.createDataFrame([(t,) for t in texts], "text string"), path)
    read_chunks(spark, path).createOrReplaceTempView("chunks")
    stored = scratch_path(spark, "vectors")
    spark.sql("SELECT *, to_vector(embed(text), 384) AS embedded_text FROM chunks").write.parquet(stored)
    vector_table(spark, stored).createOrReplaceTempView("vector_table")
    found = spark.sql(
        """SELECT text FROM vector_table
           ORDER BY array_distance(embedded_text, to_vector(embed(:question), 384)) NULLS LAST LIMIT 2""",
        args={"question": "the first book"},
    )
    assert found.first()["text"] == "the first book" and found.count() == 2


def stream_folder(spark, rows, path, files):
    for part in range(files):
        rows.where(F.col("id") % files == part).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_and_restarts_add_nothing(spark, minilm):
    rows = spark.createDataFrame([(i, f"the {i} engine") for i in range(40)], "id int, text string")
    source, sink, checkpoint = (scratch_path(spark, n) for n in ("source", "sink", "checkpoint"))
    stream_folder(spark, rows, source, 4)

    def run():
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
        write_stream(embed_stream(stream, "text", encoder_for(minilm)), sink, checkpoint).awaitTermination()
        return {r["id"]: r["embedding"] for r in spark.read.parquet(sink).collect()}

    first = run()
    batch = {r["id"]: r["embedding"] for r in embed_column(rows, "text", minilm).collect()}
    assert first.keys() == batch.keys() and spark.read.parquet(sink).count() == 40
    assert all(np.abs(np.array(first[i]) - np.array(batch[i])).max() < 1e-5 for i in batch)
    assert run() == first and spark.read.parquet(sink).count() == 40
    more = spark.createDataFrame([(40, "one more")], rows.schema)
    more.write.mode("append").parquet(source)
    assert run().keys() == batch.keys() | {40} and spark.read.parquet(sink).count() == 41


def test_routing_runs_each_model_on_its_rows_only(spark, minilm, jina):
    lines = [json.dumps({"text": f"text {i}", "model": m}) for i, m in enumerate(["embed", "embed_jina", "other"] * 4)]
    lines += ["{bad", '{"text": "no model"}']
    path = scratch_path(spark, "requests")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(2).write.text(path)
    models = {"embed": minilm, "embed_jina": jina}
    sink = scratch_path(spark, "sink")
    write_stream(route_requests(request_stream(spark, path), models), sink).awaitTermination()
    found = [(r["model"], len(r["embedding"])) for r in spark.read.parquet(sink).collect()]
    assert sorted(found) == [("embed", 384)] * 4 + [("embed_jina", 768)] * 4
    batch = accepted(parse_requests(spark.read.text(path), "value"))
    assert unrouted_requests(batch, models).count() == 5


def test_routing_equals_each_model_alone(spark, minilm, jina):
    names = ["embed", "embed_jina", "other", None]
    rows = spark.createDataFrame(
        [(i, None if i == 3 else f"the {i} light", names[i % 4]) for i in range(20)], "id int, text string, model string"
    )
    routed = {r["id"]: r["embedding"] for r in embed_routed(rows, "text", "model", {"embed": minilm, "embed_jina": jina}).collect()}
    for name, ref in (("embed", minilm), ("embed_jina", jina)):
        for r in embed_column(rows.where(F.col("model") == name), "text", ref).collect():
            assert np.abs(np.array(routed[r["id"]]) - np.array(r["embedding"])).max() < 1e-5
    assert all(routed[i] is None for i in range(20) if i % 4 > 1) and sum(v is not None for v in routed.values()) == 10
