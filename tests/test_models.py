"""Encoders against plain loops, artifacts, typed errors, and the embedding operators."""

import json
import math
import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom import embed_column, register, tokenize_column
from vecloom.errors import (
    EmbeddingError,
    ModelFileError,
    ModelHeaderError,
    ModelNotConfiguredError,
    ModelTypeError,
    TokenizerError,
    WeightsError,
)
from vecloom.models.artifacts import Weights, distribute, resolve
from vecloom.models.encoder import Encoder, alibi_slopes
from vecloom.models.runtime import encode, load_encoder, token_ids
from vecloom.models.spec import JINA, MINILM
from vecloom.testing import random_weights, seeded_model, write_weights

TINY = {"hidden": 8, "heads": 4, "intermediate": 12, "vocab": 11, "layers": 2, "max_positions": 16}


def loop_forward(spec, w, ids):
    """The encoder written element by element in double precision."""
    h, heads = spec.hidden, spec.heads
    size = h // heads

    def linear(x, name, bias=True):
        m = w[f"{name}.weight"].astype(float)
        b = w[f"{name}.bias"].astype(float) if bias else np.zeros(len(m))
        return [sum(m[o][i] * x[i] for i in range(len(x))) + b[o] for o in range(len(m))]

    def norm(x, name):
        mean = sum(x) / len(x)
        var = sum((v - mean) ** 2 for v in x) / len(x)
        g, b = w[f"{name}.weight"], w[f"{name}.bias"]
        return [(v - mean) / math.sqrt(var + spec.epsilon) * g[i] + b[i] for i, v in enumerate(x)]

    def gelu(v):
        return v * 0.5 * (1 + math.erf(v / math.sqrt(2)))

    # Slope exponents of 4 heads, a power of two.
    exponents = [2, 4, 6, 8]
    rows = []
    for t, token in enumerate(ids):
        x = w["embeddings.word_embeddings.weight"][token].astype(float) + w["embeddings.token_type_embeddings.weight"][0]
        if not spec.alibi:
            x = x + w["embeddings.position_embeddings.weight"][t]
        rows.append(norm(list(x), "embeddings.LayerNorm"))
    for layer in range(spec.layers):
        at = f"encoder.layer.{layer}."
        q, k, v = ([linear(x, f"{at}attention.self.{p}") for x in rows] for p in ("query", "key", "value"))
        after = []
        for i, x in enumerate(rows):
            merged = []
            for head in range(heads):
                part = slice(head * size, (head + 1) * size)
                scores = []
                for j in range(len(rows)):
                    score = sum(a * b for a, b in zip(q[i][part], k[j][part])) / math.sqrt(size)
                    scores.append(score - (abs(i - j) * 2.0 ** -exponents[head] if spec.alibi else 0))
                weights = [math.exp(s - max(scores)) for s in scores]
                for c in range(head * size, (head + 1) * size):
                    merged.append(sum(wt * v[j][c] for j, wt in enumerate(weights)) / sum(weights))
            out = linear(merged, f"{at}attention.output.dense")
            after.append(norm([a + b for a, b in zip(out, x)], f"{at}attention.output.LayerNorm"))
        rows = []
        for x in after:
            if spec.alibi:
                up = linear(x, f"{at}mlp.gated_layers", bias=False)
                inner = [gelu(up[i]) * up[i + spec.intermediate] for i in range(spec.intermediate)]
                out, last = linear(inner, f"{at}mlp.wo"), f"{at}mlp.layernorm"
            else:
                inner = [gelu(u) for u in linear(x, f"{at}intermediate.dense")]
                out, last = linear(inner, f"{at}output.dense"), f"{at}output.LayerNorm"
            rows.append(norm([a + b for a, b in zip(out, x)], last))
    return np.array(rows)


@pytest.mark.parametrize("base", [MINILM, JINA], ids=lambda s: s.name)
def test_encoder_equals_a_loop(base, tmp_path, monkeypatch):
    spec = replace(base, **TINY)
    tensors = random_weights(spec, 3)
    write_weights(str(tmp_path / "w"), tensors)
    encoder = Encoder(spec, Weights(str(tmp_path / "w")))
    ids = np.random.default_rng(4).integers(0, spec.vocab, (3, 9))
    expected = np.array([loop_forward(spec, tensors, row) for row in ids])
    assert np.abs(encoder.token_states(ids) - expected).max() < 2e-5
    monkeypatch.setattr("vecloom.models.encoder._SCORE_CELLS", 1)  # attention one query row at a time
    assert np.abs(encoder.token_states(ids) - expected).max() < 2e-5


def test_slopes():
    # 12 heads, exponents of 1/2.
    expected = [1, 2, 3, 4, 5, 6, 7, 8, 0.5, 1.5, 2.5, 3.5]
    assert alibi_slopes(12) == pytest.approx([-(2.0**-e) for e in expected])
    assert alibi_slopes(8) == pytest.approx([-(2.0**-e) for e in range(1, 9)])


def test_published_settings():
    assert (MINILM.hidden, MINILM.layers, MINILM.heads, MINILM.max_positions) == (384, 6, 12, 512)
    assert (JINA.hidden, JINA.layers, JINA.heads, JINA.max_positions) == (768, 12, 12, 8192)


def test_weight_types_and_prefix(tmp_path):
    halves = np.arange(4, dtype="<f2")
    brains = (np.arange(4, dtype="<f4").view("<u4") >> 16).astype("<u2")
    header = {
        "__metadata__": {"format": "pt"},
        "bert.embeddings.a": {"dtype": "F16", "shape": [2, 2], "data_offsets": [0, 8]},
        "bert.embeddings.b": {"dtype": "BF16", "shape": [4], "data_offsets": [8, 16]},
        "bert.embeddings.c": {"dtype": "I8", "shape": [1], "data_offsets": [16, 17]},
    }
    text = json.dumps(header).encode()
    path = tmp_path / "w"
    path.write_bytes(len(text).to_bytes(8, "little") + text + halves.tobytes() + brains.tobytes() + b"\0")
    weights = Weights(str(path))
    assert weights.get("embeddings.a", (2, 2)).tolist() == [[0, 1], [2, 3]]
    assert weights.get("embeddings.b", (4,)).tolist() == [0, 1, 2, 3]
    for name, shape in (("embeddings.a", (4,)), ("embeddings.c", (1,)), ("embeddings.d", (1,))):
        with pytest.raises(WeightsError):
            weights.get(name, shape)


def test_typed_errors(tmp_path, monkeypatch, minilm):
    monkeypatch.delenv("BERT_MODEL_FOLDER", raising=False)
    with pytest.raises(ModelNotConfiguredError, match="BERT_MODEL_FOLDER"):
        resolve("embed")
    with pytest.raises(ModelTypeError, match="embed_jina"):
        resolve("other")
    with pytest.raises(ModelFileError, match="tokenizer.json"):
        resolve("embed", str(tmp_path))
    (tmp_path / "tokenizer.json").write_text("{}")
    with pytest.raises(ModelFileError, match="model.safetensors"):
        resolve("embed", str(tmp_path))
    (tmp_path / "model.safetensors").write_bytes((4).to_bytes(8, "little") + b"{no}")
    ref = resolve("embed", str(tmp_path))
    with pytest.raises(ModelHeaderError):
        load_encoder(ref)
    with pytest.raises(TokenizerError):
        token_ids(ref, ["x"])
    with pytest.raises(WeightsError):  # weights of the other architecture
        load_encoder(replace(minilm, spec=replace(minilm.spec, alibi=True)))
    assert all(issubclass(e, EmbeddingError) for e in (ModelFileError, ModelTypeError, WeightsError, TokenizerError))


def test_folder_from_the_variable(monkeypatch, minilm):
    monkeypatch.setenv("BERT_MODEL_FOLDER", minilm.folder)
    assert resolve("embed").folder == minilm.folder


def test_too_long_text_is_an_error_and_truncation_is_honored(tmp_path, minilm):
    long = "hello " * 600
    with pytest.raises(TokenizerError, match="602 tokens"):
        encode(minilm, [long], 32)
    cut = seeded_model(str(tmp_path / "cut"), "embed", ["hello"], layers=1, max_length=16)
    assert [len(ids) for ids in token_ids(cut, [long, "hello"])] == [16, 3]
    assert encode(cut, [long], 32).shape == (1, 384)


def test_long_texts_of_the_second_model(jina):
    with pytest.raises(TokenizerError, match="9002 tokens"):
        encode(jina, ["hello " * 9000], 32)
    long, short = encode(jina, ["hello world " * 1000, "hello world"], 32)
    assert np.linalg.norm(long) == pytest.approx(1, abs=1e-4)
    assert np.abs(short - encode(jina, ["hello world"], 32)[0]).max() < 1e-6


def test_functions_are_unknown_before_registration(spark):
    fresh = spark.newSession()
    with pytest.raises(Exception, match="UNRESOLVED_ROUTINE"):
        fresh.sql("SELECT embed('Sam')").collect()


def test_widths_in_sql(spark, minilm, jina):
    register(spark, (minilm, jina))
    row = spark.sql(
        "SELECT array_size(embed('this is a random sentence')), array_size(embed_jina('this is a random sentence'))"
    ).first()
    assert tuple(row) == (384, 768)


def test_register_needs_folders(spark, monkeypatch):
    monkeypatch.delenv("BERT_MODEL_FOLDER", raising=False)
    with pytest.raises(ModelNotConfiguredError):
        register(spark)


def test_null_empty_and_odd_texts(spark, minilm):
    register(spark, (minilm,))
    texts = [(0, None), (1, ""), (2, "   "), (3, "🙂 é"), (4, "the first year")]
    rows = spark.createDataFrame(texts, "id int, text string")
    found = {r["id"]: r["embedding"] for r in embed_column(rows, "text", minilm).collect()}
    assert found[0] is None
    assert all(len(found[i]) == 384 and np.linalg.norm(found[i]) == pytest.approx(1, abs=1e-5) for i in range(1, 5))
    assert found[1] == found[2]  # both only the special tokens
    assert spark.sql("SELECT embed(NULL) IS NULL").first()[0]


def test_invalid_bytes_embed_as_the_replacement_character(spark, minilm):
    rows = spark.createDataFrame([(bytearray(b"the \xff"),)], "text binary")
    found = embed_column(rows, "text", minilm).first()["embedding"]
    assert found == pytest.approx(list(encode(minilm, ["the �"], 32)[0]), abs=1e-6)


def test_invalid_bytes_in_sql(spark, minilm):
    register(spark, (minilm,))
    row = spark.sql("SELECT embed(CAST(X'74686520FF' AS STRING)) a, embed('the \ufffd') b").first()
    assert row["a"] == row["b"]


def test_non_string_argument_is_an_error(spark, minilm):
    register(spark, (minilm,))
    with pytest.raises(Exception, match="expects STRING"):
        spark.sql("SELECT embed(5)").collect()


TEXTS = [" ".join(["hello", "world", "the", "engine", "of", "light"][i % 6 :: 1] * (1 + i % 5)) for i in range(90)]


@pytest.mark.parametrize("model", ["minilm", "jina"])
def test_result_depends_on_neither_batches_nor_partitions(spark, request, model):
    ref = request.getfixturevalue(model)
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    alone = np.concatenate([encode(ref, [text], 1) for text in TEXTS])
    for batch_size, partitions in ((1, 3), (7, 1), (32, 5), (1000, 2)):
        found = embed_column(rows, "text", ref, batch_size=batch_size, partitions=partitions).collect()
        assert len(found) == len(TEXTS)
        for r in found:
            assert np.abs(np.array(r["embedding"]) - alone[r["id"]]).max() < 1e-5


def test_encoder_runs_once_with_a_filter_on_the_result(spark, minilm):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    embedded = embed_column(rows, "text", minilm)
    plan = embedded.where(F.get("embedding", F.lit(0)) > 0).orderBy(F.get("embedding", F.lit(1)))
    assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [embed") == 1
    unused = embedded.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in unused


def test_each_worker_loads_a_model_once(spark, minilm):
    def loads(batches):
        import os

        import pyarrow as pa

        from vecloom.models.runtime import load_encoder

        for _ in batches:
            load_encoder(minilm)
        yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "misses": [load_encoder.cache_info().misses]})

    rows = spark.range(0, 400, 1, 40).mapInArrow(loads, "pid bigint, misses bigint").collect()
    assert len({r["pid"] for r in rows}) <= spark.sparkContext.defaultParallelism + 4
    assert max(r["misses"] for r in rows) <= 4  # one per model this worker has seen in the session


def test_distributed_files_are_used(spark, minilm):
    sent = distribute(spark, minilm, always=True)
    assert sent.tag and os.path.isfile(sent.path("model.safetensors"))
    rows = spark.createDataFrame([("hello world",)], "text string")
    here, there = (embed_column(rows, "text", ref).first()["embedding"] for ref in (minilm, sent))
    assert here == there


def test_tokenize(spark, minilm):
    rows = spark.createDataFrame([(0, "The engine, unknownword!"), (1, ""), (2, None)], "id int, text string")
    found = {r["id"]: (r["ids"], r["mask"]) for r in tokenize_column(rows, "text", minilm).collect()}
    assert found[1] == ([2, 3], [1, 1]) and found[2] == (None, None)
    ids, mask = found[0]
    assert ids[0] == 2 and ids[-1] == 3 and ids[3] == 1 and len(ids) == 5 and mask == [1] * 5
