"""

tables. Sentence-encoder queries use the folders of BERT_MODEL_FOLDER and JINA_MODEL_FOLDER
where those are set; else seeded random weights in the real layout and width.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
from collections.abc import Callable
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from vecloom.functions.registry import register, register_vector_functions  # noqa: E402
from vecloom.functions.vectors import (  # noqa: E402
    array_distance,
    l2_normalize,
    mean_pool,
    rank_distance,
    to_vector,
    valid_text,
    vector_width,
)
from vecloom.models.artifacts import distribute, resolve  # noqa: E402
from vecloom.models.spec import spec_of  # noqa: E402
from vecloom.operators.cells import (  # noqa: E402
    append_cells,
    build_cells,
    calibrate_cells,
    fit_centroids,
    recall_curve,
    topk_cells,
    with_cells,
)
from vecloom.operators.embed import embed_column, tokenize_column  # noqa: E402
from vecloom.operators.hashing import embed_hash  # noqa: E402
from vecloom.operators.lsh import lsh_join, random_projections  # noqa: E402
from vecloom.operators.lsh_self import lsh_self_join  # noqa: E402
from vecloom.operators.placement import embed_distinct  # noqa: E402
from vecloom.operators.pooling import mean_pool_groups  # noqa: E402
from vecloom.operators.topk import topk, topk_batch  # noqa: E402
from vecloom.operators.vocabulary import with_word_ids, word_vocabulary, words_of  # noqa: E402
from vecloom.plans.retrieval import ask, retrieve, retrieve_from  # noqa: E402
from vecloom.session import dealt, materialize, scratch_path, spread  # noqa: E402
from vecloom.sources.chunks import read_chunks, write_chunks  # noqa: E402
from vecloom.sources.requests import accepted, parse_requests, respond  # noqa: E402
from vecloom.sources.tables import build_vector_table, inline_texts  # noqa: E402
from vecloom.streaming.embed_stream import (  # noqa: E402
    answer_requests,
    embed_stream,
    parsed_stream,
    request_stream,
    route_encoders,
    route_requests,
    write_stream,
)
from vecloom.testing import SPECIAL_TOKENS, seeded_model  # noqa: E402

DIM = 384
SEPARATORS = r"[^\p{L}\p{N}]+"

INLINE_QUESTIONS = [
    "Which river is the longest?",
    "Who can tell what the letter says?",
    "Where do the old roads lead to, and when were they built?",
    "Why is bread eaten in every house?",
    "Is it true that nobody's left in the valley?",
]
QUOTED_QUESTION = "What's the plot of the book?"

LSH = {"tables": 4, "width": 2, "bucket_length": 1.0}
LSH_MAX_DIST = 1.15
LSH_PROJECTIONS = random_projections(64, LSH["tables"], LSH["width"], LSH["bucket_length"], seed=42)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hash(df: DataFrame, text_col: str = "text", out_col: str = "embedding") -> DataFrame:
    return embed_hash(df, text_col, out_col, DIM)


def _hashed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table with the hash vectors of its texts."""
    path = scratch_path(spark, name)
    return build_vector_table(spread(_read(spark, sf_dir, name)), _hash, path, DIM)


_models: dict = {}


def _vocabulary() -> list[str]:
    """The whole words of a public tokenizer, in the order of their ids; its size does not depend on the data."""
    import public_tokenizers

    with open(os.environ.get("WORD_VOCABULARY") or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = (token.removesuffix("</w>") for token in sorted(vocab, key=vocab.get) if token.endswith("</w>"))
    return [word for word in dict.fromkeys(words) if word.isascii() and word.isalnum()]


def _model(spark: SparkSession, sf_dir: str, name: str):
    """The configured model, or a seeded one with all its layers and a fixed vocabulary, that of a tokenizer file."""
    spec = spec_of(name)
    if os.environ.get(spec.folder_variable):
        return distribute(spark, resolve(spec))
    key = (spark.sparkContext.applicationId, name)
    if key not in _models:
        folder = os.path.join(tempfile.mkdtemp(prefix="vecloom-model-"), name)
        _models[key] = distribute(spark, seeded_model(folder, name, _vocabulary(), layers=spec.layers))
    return _models[key]


def _elements(df: DataFrame, keys: list[str], vec: str, pos: str, value: str) -> DataFrame:
    return df.select(*keys, F.posexplode(vec).alias(pos, value)).withColumn(value, F.round(F.col(value).cast("double"), 6))


def _filled(df: DataFrame, keys: list[str], vec: str = "embedding") -> DataFrame:
    """(keys, bucket, value) of the elements that are numbers but 0; a row without any keeps one row of NULLs."""
    element = lambda x, i: F.struct(i.alias("bucket"), F.round(x.cast("double"), 6).alias("value"))
    filled = F.filter(F.transform(vec, element), lambda e: (e["value"] != 0) & ~F.isnan(e["value"]))
    return df.select(*keys, F.explode_outer(filled).alias("e")).select(*keys, "e.bucket", "e.value")


# Sources and sinks


def s1_inline_questions(spark, sf_dir):
    inline_texts(spark, "questions", "random_questions", INLINE_QUESTIONS)
    asked = _hash(spark.sql("SELECT random_questions FROM questions"), "random_questions")
    hits = topk_batch(_hashed(spark, sf_dir, "documents"), asked, 5, "doc_id", qid="random_questions")
    return hits.withColumn("distance", rank_distance("distance"))


def s2_csv_chunks(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_chunks(_read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars"), path)
    return read_chunks(spark, path, schema="doc_id bigint, text string, lang string, n_chars bigint")


def s3_vector_scan(spark, sf_dir):
    rows = _read(spark, sf_dir, "embeddings")
    return _elements(rows, ["vec_id", "label"], "embedding", "pos", "value")


def s4_vector_table(spark, sf_dir):
    table = _hashed(spark, sf_dir, "documents").withColumn("width", vector_width("embedding"))
    return _filled(table, ["doc_id", "lang", "source", "width"])


def s5_json_requests(spark, sf_dir):
    talk = _read(spark, sf_dir, "conversations")
    good = F.to_json(F.struct("text"))
    body = (
        F.when(F.col("role") == "user", good)
        .when(F.col("role") == "assistant", F.expr("substring(to_json(struct(text)), 2)"))
        .otherwise(F.to_json(F.struct(F.col("text").alias("note"))))
    )
    parsed = parse_requests(talk.select("conv_id", "turn", body.alias("request")), "request")
    answered = respond(_hash(parsed))
    back = F.from_json("response", "embedded_text array<float>")["embedded_text"]
    return answered.select(
        "conv_id",
        "turn",
        F.coalesce("reject_reason", F.lit("accepted")).alias("status"),
        F.length("text").alias("text_length"),
        vector_width(back).alias("width"),
        F.array_size(F.filter(back, lambda x: x != 0)).alias("filled"),
    )


# Projections and casts


def p1_select_star_plus(spark, sf_dir):
    register_vector_functions(spark)
    spread(_read(spark, sf_dir, "documents")).createOrReplaceTempView("chunks")
    embedded = spark.sql("SELECT *, to_vector(embed_hash(text), 384) AS embedded_text FROM chunks")
    # Of the vector: its width, and the signs of its elements summed by place. A vector of NaN (no token, or all of
    # them cancel out) has neither signs nor a largest element; NaN can't be cast to a whole number.
    signs = F.transform("embedded_text", lambda x, i: F.when(~F.isnan(x), F.signum(x)).cast("long") * (i + 1))
    largest = F.array_max("embedded_text").cast("double")
    return embedded.select(
        *embedded.columns[:-1],
        F.aggregate(signs, F.lit(0).cast("long"), lambda s, x: s + x).alias("signed_places"),
        F.when(~F.isnan(largest), F.round(largest, 6)).alias("largest"),
        vector_width("embedded_text").alias("embedded_text"),
    )


def p3_to_vector(spark, sf_dir):
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", to_vector("embedding", 64).alias("vector"))
    return rows.select(
        "vec_id", vector_width("vector").alias("width"), F.round(F.get("vector", F.lit(63)).cast("double"), 6).alias("last")
    )


def p4_text_only(spark, sf_dir):
    return ask(_hashed(spark, sf_dir, "documents"), QUOTED_QUESTION, _hash, 5, "doc_id").select("text")


def p5_question_parameter(spark, sf_dir):
    register_vector_functions(spark)
    _hashed(spark, sf_dir, "documents").createOrReplaceTempView("vector_table")
    question = spark.sql("SELECT to_vector(embed_hash(:question), 384) AS v", args={"question": QUOTED_QUESTION})
    return spark.sql(
        """SELECT doc_id, round(vector_distance(embedding, CAST(:v AS array<float>)), 6) AS distance
           FROM vector_table ORDER BY distance NULLS LAST, doc_id LIMIT 5""",
        args={"v": F.array(*map(F.lit, question.first()["v"]))},
    )


# Embedding


def _width_and_norm(df: DataFrame) -> DataFrame:
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return df.select("conv_id", "turn", vector_width("embedding").alias("width"), F.round(norm, 4).alias("norm"))


def e1_embed(spark, sf_dir):
    talk = dealt(_read(spark, sf_dir, "conversations"))
    return _width_and_norm(embed_column(talk, "text", _model(spark, sf_dir, "embed")))


def e2_embed_jina(spark, sf_dir):
    talk = dealt(_read(spark, sf_dir, "conversations"))
    return _width_and_norm(embed_column(talk, "text", _model(spark, sf_dir, "embed_jina")))


def e3_batch_invariance(spark, sf_dir):
    talk, ref = _read(spark, sf_dir, "conversations"), _model(spark, sf_dir, "embed")
    keys = ["conv_id", "turn"]
    one = embed_column(dealt(talk.select(*keys, "text")), "text", ref, "one", batch_size=32).drop("text")
    two = embed_column(dealt(talk.select(*keys, "text"), less=3), "text", ref, "two", batch_size=5).drop("text")
    return one.join(two, keys).select(*keys, (array_distance("one", "two") < 1e-5).alias("same"))


def e4_tokenize(spark, sf_dir):
    documents = spread(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    tokens = tokenize_column(documents, "text", _tokens_only(spark, sf_dir))
    sized = tokens.select("doc_id", F.array_size("mask").alias("n_tokens"), words_of("text").alias("words"))
    # One id a word, by frequency in `conversations`, after those of the special tokens.
    vocabulary = word_vocabulary(_read(spark, sf_dir, "conversations"), "text", len(SPECIAL_TOKENS))
    numbered = with_word_ids(sized, "words", vocabulary, "ids", SPECIAL_TOKENS.index("[UNK]"))
    first, last = (F.lit(str(SPECIAL_TOKENS.index(token))) for token in ("[CLS]", "[SEP]"))
    return numbered.withColumn("ids", F.concat_ws(" ", first, F.col("ids").cast("array<string>"), last))


def _tokens_only(spark, sf_dir):
    """The seeded tokenizer without a limit on positions, for texts of any length."""
    from dataclasses import replace

    ref = _model(spark, sf_dir, "embed")
    return replace(ref, spec=replace(ref.spec, max_positions=1 << 31))


def e5_length_groups(spark, sf_dir):
    documents = spread(_read(spark, sf_dir, "documents").select("text"))
    tokens = tokenize_column(documents, "text", _tokens_only(spark, sf_dir))
    return tokens.groupBy(F.array_size("ids").alias("n_tokens")).agg(F.count("*").alias("texts"))


def e8_mean_pool(spark, sf_dir):
    pooled = mean_pool_groups(_read(spark, sf_dir, "embeddings"), "label", "embedding")
    return _elements(pooled, ["label"], "embedding", "pos", "value")


def e8_masked_mean_pool(spark, sf_dir):
    rows = _read(spark, sf_dir, "embeddings").withColumn("mask", (F.col("vec_id") % 3 != 0).cast("int"))
    pooled = mean_pool_groups(rows, "label", "embedding", "mask")
    return _elements(pooled, ["label"], "embedding", "pos", "value")


def e8_mean_pool_rows(spark, sf_dir):
    """Eight token vectors of width 8 from each vector; a mask that changes from row to row."""
    parts = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, F.lit(8)))
    mask = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: ((i + F.col("vec_id")) % 3 != 0).cast("int"))
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", mean_pool(parts, mask).alias("pooled"))
    return _elements(rows, ["vec_id"], "pooled", "pos", "value")


def e9_l2_normalize(spark, sf_dir):
    doubled = F.transform("embedding", lambda x: x.cast("double") * 2 + 1)
    unit = _read(spark, sf_dir, "embeddings").select("vec_id", l2_normalize(doubled).alias("unit"))
    return _elements(unit, ["vec_id"], "unit", "pos", "value")


def e11_valid_text(spark, sf_dir):
    raw = F.concat(F.lit("<").cast("binary"), F.unhex(F.lit("FF")), F.col("text").cast("binary"), F.unhex(F.lit("C3")))
    return _read(spark, sf_dir, "documents").select("doc_id", valid_text(raw).alias("text"))


def e13_hash_vectors(spark, sf_dir):
    vectors = _hash(spread(_read(spark, sf_dir, "documents").select("doc_id", "text")))
    return _elements(vectors, ["doc_id"], "embedding", "bucket", "value").where("value <> 0")


def e13_distinct_texts(spark, sf_dir):
    """Each different text hashed once, in tasks of even cost, and joined back to all its rows."""
    rows = _read(spark, sf_dir, "documents").select("doc_id", "text")
    vectors = embed_distinct(rows, "text", _hash)
    return _elements(vectors, ["doc_id"], "embedding", "bucket", "value").where("value <> 0")


# Vector functions


def v1_array_distance(spark, sf_dir):
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    following = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    pairs = rows.join(following, "vec_id")
    return pairs.select("vec_id", rank_distance(array_distance("embedding", "next")).alias("distance"))


def v2_vector_width(spark, sf_dir):
    return _read(spark, sf_dir, "embeddings").select("vec_id", vector_width("embedding").alias("width"))


# Search


def k1_topk(spark, sf_dir):
    rows = _read(spark, sf_dir, "embeddings")
    center = mean_pool_groups(rows.withColumn("all", F.lit(1)), "all", "embedding").first()["embedding"]
    nearest = topk(rows, center, 10, "vec_id")
    return nearest.select("vec_id", "label", rank_distance("distance").alias("distance"))


def k2_topk_vectors(spark, sf_dir):
    rows = _read(spark, sf_dir, "embeddings")
    asked = rows.select(F.col("vec_id").alias("qid"), "embedding")
    return topk_batch(rows, asked, 5, "vec_id").withColumn("distance", rank_distance("distance"))


def k2_topk_in_blocks(spark, sf_dir):
    """The way of a question table too large for one broadcast: blocks meet parts of the corpus in one job."""
    rows = _read(spark, sf_dir, "embeddings")
    asked = rows.select(F.col("vec_id").alias("qid"), "embedding")
    found = topk_batch(rows, asked, 5, "vec_id", max_question_bytes=rows.count() * 300)
    return found.withColumn("distance", rank_distance("distance"))


def k2_topk_documents(spark, sf_dir):
    documents, asked = _hashed(spark, sf_dir, "documents"), _hashed(spark, sf_dir, "benchmark")
    hits = retrieve_from(documents, asked, 5, "doc_id", "text", "item_id")
    return hits.select("item_id", "rank", "doc_id", F.length("text").alias("text_length"), rank_distance("distance").alias("distance"))


def _label_means(spark, rows: DataFrame) -> DataFrame:
    means = mean_pool_groups(rows, "label", "embedding", out_col="centroid")
    centroids = means.select(F.col("label").alias("cell"), F.col("centroid").cast("array<double>").alias("centroid"))
    return materialize(centroids, "centroids")


def k3_cells(spark, sf_dir):
    """Questions joined with the rows of their cells, the way of a table too large for one broadcast."""
    rows = _read(spark, sf_dir, "embeddings")
    index = build_cells(rows, "vec_id", "embedding", scratch_path(spark, "cells"), _label_means(spark, rows))
    asked = rows.select(F.col("vec_id").alias("qid"), "embedding")
    found = topk_cells(spark, index, asked, nprobe=3, k=5, max_question_bytes=0)
    return found.withColumn("distance", rank_distance("distance"))


def k3_cells_appended(spark, sf_dir):
    """As `k3_cells`, with the rows in two loads: half of them are added to the built index."""
    rows, even = _read(spark, sf_dir, "embeddings"), F.coalesce(F.col("vec_id") % 2 == 0, F.lit(True))
    index = build_cells(rows.where(even), "vec_id", "embedding", scratch_path(spark, "cells"), _label_means(spark, rows))
    append_cells(rows.where(~even), index)
    asked = rows.select(F.col("vec_id").alias("qid"), "embedding")
    found = topk_cells(spark, index, asked, nprobe=3, k=5, max_question_bytes=0)
    return found.withColumn("distance", rank_distance("distance"))


def k3_many_cells(spark, sf_dir):
    """The three nearest cells of every row, where each tenth row is a cell: as many as the table gives."""
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    tenth = rows.where("vec_id % 10 = 0").select(F.col("vec_id").alias("cell"), F.col("embedding").alias("centroid"))
    placed = with_cells(rows, "embedding", "cells", materialize(tenth, "centroids"), 3)
    return placed.select("vec_id", F.posexplode("cells").alias("place", "cell"))


def k3_recall_curve(spark, sf_dir):
    """Recall at every nprobe, measured on half of the rows and carried on as the others are added."""
    rows, even = _read(spark, sf_dir, "embeddings"), F.coalesce(F.col("vec_id") % 2 == 0, F.lit(True))
    index = build_cells(rows.where(even), "vec_id", "embedding", scratch_path(spark, "cells"), _label_means(spark, rows))
    asked = rows.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), "embedding")
    calibrate_cells(spark, index, 5, asked)
    append_cells(rows.where(~even), index)
    return recall_curve(spark, index).select("nprobe", "expected", "hit", "recall")


def k3_cells_all_probes(spark, sf_dir):
    """K-means cells, all of them searched: the exact result."""
    rows = _read(spark, sf_dir, "embeddings")
    centroids = fit_centroids(rows, "embedding", 8)
    index = build_cells(rows, "vec_id", "embedding", scratch_path(spark, "cells"), centroids)
    asked = rows.select(F.col("vec_id").alias("qid"), "embedding")
    return topk_cells(spark, index, asked, nprobe=8, k=5).withColumn("distance", rank_distance("distance"))


def k4_lsh_self_join(spark, sf_dir):
    """One signed table, each pair compared once, in blocks of 64 rows; different vectors by their first keys."""
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    pairs = lsh_self_join(rows, LSH_MAX_DIST, "vec_id", "other_id", projections=LSH_PROJECTIONS, block_rows=64, **LSH)
    return pairs.withColumn("distance", rank_distance("distance"))


def k4_lsh_join(spark, sf_dir):
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    others = rows.withColumnRenamed("vec_id", "other_id")
    pairs = lsh_join(rows, others, LSH_MAX_DIST, "vec_id", "other_id", projections=LSH_PROJECTIONS, **LSH)
    return pairs.where("vec_id < other_id").withColumn("distance", rank_distance("distance"))


def k4_lsh_join_shuffled(spark, sf_dir):
    """The way of two tables too large for a broadcast: both shuffled by code, in small pieces."""
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    others = rows.withColumnRenamed("vec_id", "other_id")
    pairs = lsh_join(
        rows, others, LSH_MAX_DIST, "vec_id", "other_id",
        projections=LSH_PROJECTIONS, block_rows=64, broadcast_bytes=0, **LSH,
    )
    return pairs.where("vec_id < other_id").withColumn("distance", rank_distance("distance"))


def k5_retrieve(spark, sf_dir, **search):
    path = scratch_path(spark, "csv")
    write_chunks(spread(_read(spark, sf_dir, "documents")).select("doc_id", "text"), path)
    questions = _read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))
    found = retrieve(spark, path, questions, _hash, DIM, 5, "doc_id", schema="doc_id bigint, text string", **search)
    return found.select("qid", "rank", "doc_id", "text", rank_distance("distance").alias("distance"))


def k5_retrieve_cells(spark, sf_dir):
    """Retrieval by a cell index, all cells searched: the exact result."""
    return k5_retrieve(spark, sf_dir, cells=8, nprobe=8)


# Streaming and SQL names


def _stream_result(spark, stream: DataFrame) -> DataFrame:
    path = scratch_path(spark, "sink")
    write_stream(stream, path).awaitTermination()
    return spark.read.parquet(path)


def t1_embed_stream(spark, sf_dir):
    talk = _read(spark, sf_dir, "conversations")
    # A pattern, as a stream takes a plain path for a folder; it stands for one file as well as for a folder of files.
    stream = spark.readStream.schema(talk.schema).parquet(f"{sf_dir}/{{conversations}}.parquet")
    stored = _stream_result(spark, embed_stream(stream, "text", _hash))
    stored = stored.withColumn("width", vector_width("embedding"))
    return _filled(stored, ["conv_id", "turn", "width"])


def t1_stream_requests(spark, sf_dir):
    """Every streamed request is answered once: with a vector, or with what is wrong with it."""
    talk = _read(spark, sf_dir, "conversations")
    key = F.concat_ws("/", "conv_id", "turn")
    model = F.when(F.length("text") % 5 == 0, "other").otherwise("hash")
    body = (
        F.when(F.col("role") == "user", F.to_json(F.struct(key.alias("id"), "text", model.alias("model"))))
        .when(F.col("role") == "assistant", F.concat(F.lit("broken "), key))
        .otherwise(F.to_json(F.struct(key.alias("id"), F.col("text").alias("note"))))
    )
    path = scratch_path(spark, "requests")
    spread(talk.select(body.alias("value"))).write.text(path)
    stored = _stream_result(spark, answer_requests(parsed_stream(spark, path, request_key="id"), _hash, ["hash"]))
    back = F.from_json("response", "embedded_text array<float>")["embedded_text"]
    keyed = stored.select(F.coalesce("id", "value").alias("request"), "status", back.alias("embedding"))
    return _filled(keyed, ["request", "status"])


def t2_route_requests(spark, sf_dir):
    talk = _read(spark, sf_dir, "conversations")
    model = F.when(F.col("role") == "assistant", "embed").otherwise("embed_jina").alias("model")
    lines = talk.select(F.to_json(F.struct("text", model)).alias("value"))
    path = scratch_path(spark, "requests")
    spread(lines).write.text(path)
    models = {name: _model(spark, sf_dir, name) for name in ("embed", "embed_jina")}
    stored = _stream_result(spark, route_requests(dealt(request_stream(spark, path)), models))
    return stored.select("text", "model", vector_width("embedding").alias("width"))


ROUTES = {"narrow": 96, "wide": DIM}


def t2_route_hashes(spark, sf_dir):
    """Each request by the encoder that it names: hash vectors of two widths, compared by value."""
    talk = _read(spark, sf_dir, "conversations")
    model = F.when(F.col("role") == "assistant", "narrow").when(F.col("role") == "user", "wide").otherwise("other")
    body = F.to_json(F.struct(F.concat_ws("/", "conv_id", "turn").alias("id"), "text", model.alias("model")))
    path = scratch_path(spark, "requests")
    spread(talk.select(body.alias("value"))).write.text(path)
    encoders = {name: partial(embed_hash, dim=dim) for name, dim in ROUTES.items()}
    parsed = accepted(parsed_stream(spark, path, request_key="id"))
    stored = _stream_result(spark, route_encoders(parsed, encoders))
    return _filled(stored.withColumn("width", vector_width("embedding")), ["id", "model", "width"])


def u1_registered_functions(spark, sf_dir):
    register(spark, (_model(spark, sf_dir, "embed"), _model(spark, sf_dir, "embed_jina")))
    _read(spark, sf_dir, "benchmark").createOrReplaceTempView("questions")
    return spark.sql(
        "SELECT item_id, array_size(embed(text)) AS width, array_size(embed_jina(text)) AS width_jina FROM questions"
    )


def _training_data_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries of the training-data operators and their pipeline, where those are installed."""
    found: dict = {}
    try:
        from vecloom.llm.queries import QUERIES

        found |= QUERIES
        import corpus_pipeline
    except ModuleNotFoundError as error:
        if error.name not in ("vecloom.llm", "vecloom.llm.queries", "corpus_pipeline"):
            raise
        return found
    return found | {"pipeline": corpus_pipeline.run}


def _training_data_sql() -> dict[str, str]:
    try:
        from vecloom.llm.queries import ORACLE_SQL
    except ModuleNotFoundError as error:
        if error.name not in ("vecloom.llm", "vecloom.llm.queries"):
            raise
        return {}
    return dict(ORACLE_SQL)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        s1_inline_questions, s2_csv_chunks, s3_vector_scan, s4_vector_table, s5_json_requests,
        p1_select_star_plus, p3_to_vector, p4_text_only, p5_question_parameter,
        e1_embed, e2_embed_jina, e3_batch_invariance, e4_tokenize, e5_length_groups,
        e8_mean_pool, e8_masked_mean_pool, e8_mean_pool_rows, e9_l2_normalize, e11_valid_text, e13_hash_vectors,
        e13_distinct_texts,
        v1_array_distance, v2_vector_width,
        k1_topk, k2_topk_vectors, k2_topk_in_blocks, k2_topk_documents,
        k3_cells, k3_cells_appended, k3_cells_all_probes, k3_many_cells, k3_recall_curve,
        k4_lsh_join, k4_lsh_join_shuffled, k4_lsh_self_join,
        k5_retrieve, k5_retrieve_cells, t1_embed_stream, t1_stream_requests, t2_route_requests, t2_route_hashes,
        u1_registered_functions,
    ]
    return {query.__name__: query for query in listed} | _training_data_queries()


def entry(spark: SparkSession) -> DataFrame:
    """Retrieval end to end: CSV chunks, hash vectors, stored table, top 5 per question."""
    return k5_retrieve(spark, "/root/testdata/sf0.001")


# The same results in SQL


def _tokens_sql(name: str, table: str, key: str, text: str = "text") -> str:
    """Token rows (id, t)."""
    split = f"regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')"
    return f"{name} AS MATERIALIZED (SELECT id, t FROM (SELECT {key} AS id, unnest({split}) AS t FROM {table}) WHERE t <> '')"


def _hash_sql(name: str, table: str, key: str, text: str = "text", dim: int = DIM) -> str:
    """Sparse hash vectors (id, bucket, x) and their squared norms (id, n2)."""
    return f"""{_tokens_sql(name + "_t", table, key, text)},
{name}_c AS MATERIALIZED (
  SELECT id, h % {dim} AS bucket, sum(CASE WHEN (h // {dim}) % 2 = 0 THEN 1 ELSE -1 END) AS w
  FROM (SELECT id, ('0x' || substr(md5(t), 1, 8))::BIGINT AS h FROM {name}_t) GROUP BY ALL),
{name}_l AS MATERIALIZED (SELECT id, sqrt(sum(w * w)::DOUBLE) AS n FROM {name}_c GROUP BY id),
{name} AS MATERIALIZED (
  SELECT id, bucket, (w::DOUBLE / n)::FLOAT::DOUBLE AS x FROM {name}_c JOIN {name}_l USING (id) WHERE w <> 0),
{name}_n AS MATERIALIZED (SELECT id, sum(x * x) AS n2 FROM {name} GROUP BY id)"""


def _search_sql(k: int) -> str:
    """Ranked (qid, did, distance, rank) of sparse vectors q and d."""
    return f"""dot AS MATERIALIZED (
  SELECT q.id AS qid, d.id AS did, sum(q.x * d.x) AS dot FROM q JOIN d USING (bucket) GROUP BY ALL),
pairs AS (
  SELECT q_n.id AS qid, d_n.id AS did,
         round(sqrt(greatest(0, q_n.n2 + d_n.n2 - 2 * coalesce(dot, 0))), 6) AS distance
  FROM q_n CROSS JOIN d_n LEFT JOIN dot ON dot.qid = q_n.id AND dot.did = d_n.id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, did)::INTEGER AS rank FROM pairs
  QUALIFY rank <= {k})"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(texts: list[str]) -> str:
    return "(VALUES " + ", ".join(f"({_quoted(text)})" for text in texts) + ") AS v(text)"


def _constant_widths(width: int) -> str:
    return f"SELECT conv_id, turn, {width} AS width, 1.0::DOUBLE AS norm FROM conversations"


def oracle_sql() -> dict[str, str]:
    one = f"{_hash_sql('q', _values([QUOTED_QUESTION]), '0')},\n{_hash_sql('d', 'documents', 'doc_id')},\n{_search_sql(5)}"
    asked = f"{_hash_sql('q', 'benchmark', 'item_id')},\n{_hash_sql('d', 'documents', 'doc_id')},\n{_search_sql(5)}"
    vectors = "vectors AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
    vocabulary = f"""words AS MATERIALIZED (
  SELECT t, row_number() OVER (ORDER BY count(*) DESC, t) + {len(SPECIAL_TOKENS) - 1} AS id
  FROM w GROUP BY t)"""
    split = "regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')"
    length = f"len(list_filter({split}, lambda t: t <> '')) + 2"
    directions, offsets = LSH_PROJECTIONS
    projections = ", ".join(
        f"({number}, {[float(x) for x in direction]}, {float(offset)!r})"
        for number, (direction, offset) in enumerate(zip(directions, offsets, strict=True))
    )
    distance = "round(list_distance({a}, {b}), 6)"

    near = f"""WITH {vectors},
projections(number, direction, shift) AS (VALUES {projections}),
codes AS MATERIALIZED (
  SELECT vec_id, number // {LSH['width']} AS tab,
    string_agg(floor((list_inner_product(v, direction::DOUBLE[]) + shift) / {LSH['bucket_length']})::BIGINT::VARCHAR, ','
               ORDER BY number) AS code
  FROM vectors CROSS JOIN projections GROUP BY ALL),
candidates AS (
  SELECT DISTINCT a.vec_id, b.vec_id AS other_id FROM codes a JOIN codes b USING (tab, code) WHERE a.vec_id < b.vec_id)
SELECT c.vec_id, c.other_id, {distance.format(a='a.v', b='b.v')} AS distance
FROM candidates c JOIN vectors a ON a.vec_id = c.vec_id JOIN vectors b ON b.vec_id = c.other_id
WHERE list_distance(a.v, b.v) <= {LSH_MAX_DIST}"""
    nearest = f"""WITH {vectors}
SELECT a.vec_id AS qid, b.vec_id, {distance.format(a='a.v', b='b.v')} AS distance,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY {distance.format(a='a.v', b='b.v')}, b.vec_id)::INTEGER AS rank
FROM vectors a CROSS JOIN vectors b QUALIFY rank <= 5"""

    cells = f"""WITH {vectors},
centers AS MATERIALIZED (
  SELECT cell, list(x ORDER BY pos) AS c FROM (
    SELECT label AS cell, pos, avg(x)::FLOAT::DOUBLE AS x
    FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM vectors) GROUP BY label, pos)
  GROUP BY cell),
near AS MATERIALIZED (
  SELECT vec_id, v, cell,
    row_number() OVER (PARTITION BY vec_id ORDER BY {distance.format(a='v', b='c')}, cell) AS place
  FROM vectors CROSS JOIN centers)"""
    in_cells = f"""{cells}
SELECT q.vec_id AS qid, r.vec_id, {distance.format(a='q.v', b='r.v')} AS distance,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY {distance.format(a='q.v', b='r.v')}, r.vec_id)::INTEGER AS rank
FROM near q JOIN near r ON q.cell = r.cell AND q.place <= 3 AND r.place = 1
QUALIFY rank <= 5"""
    hashed = f"""WITH {_hash_sql('d', 'documents', 'doc_id')}
SELECT id AS doc_id, bucket::INTEGER AS bucket, round(x, 6) + 0.0 AS value FROM d WHERE round(x, 6) <> 0"""
    curve = f"""{cells},
best AS MATERIALIZED (
  SELECT a.vec_id AS qid, b.vec_id,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY {distance.format(a='a.v', b='b.v')}, b.vec_id) AS rank
  FROM vectors a CROSS JOIN vectors b WHERE a.vec_id % 20 = 0 QUALIFY rank <= 5),
places AS (
  SELECT n.place FROM best JOIN near h ON h.vec_id = best.vec_id AND h.place = 1
  JOIN near n ON n.vec_id = best.qid AND n.cell = h.cell)
SELECT nprobe, expected, hit, hit / expected AS recall FROM (
  SELECT place::INTEGER AS nprobe, (SELECT count(*) FROM places) AS expected,
    (sum(count(*)) OVER (ORDER BY place))::BIGINT AS hit
  FROM places GROUP BY place)"""
    retrieved = f"""WITH {asked}
SELECT qid, rank, did AS doc_id, text, distance FROM ranked JOIN documents ON doc_id = did"""

    def pooled(mask: str) -> str:
        return f"""SELECT label, pos,
  round((sum(x * m) / greatest(sum(m), 1e-8))::FLOAT::DOUBLE, 6) + 0.0 AS value
FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1)::INTEGER - 1 AS pos,
      {mask} AS m FROM embeddings) GROUP BY label, pos"""

    return {
        "s1_inline_questions": f"""WITH {_hash_sql('q', _values(INLINE_QUESTIONS), 'text')},
{_hash_sql('d', 'documents', 'doc_id')},
{_search_sql(5)}
SELECT qid AS random_questions, rank, did AS doc_id, distance FROM ranked""",
        "s2_csv_chunks": "SELECT doc_id, text, lang, n_chars FROM documents",
        "s3_vector_scan": """SELECT vec_id, label, generate_subscripts(embedding, 1)::INTEGER - 1 AS pos,
  round(unnest(embedding)::DOUBLE, 6) + 0.0 AS value FROM embeddings""",
        "s4_vector_table": f"""WITH {_hash_sql('d', 'documents', 'doc_id')}
SELECT doc_id, lang, source, CASE WHEN text IS NOT NULL THEN {DIM} END AS width, bucket::INTEGER AS bucket,
  round(x, 6) + 0.0 AS value
FROM documents LEFT JOIN d ON d.id = doc_id AND round(x, 6) <> 0""",
        "s5_json_requests": f"""WITH {_hash_sql('d', 'conversations', "conv_id || '/' || turn")},
filled AS (SELECT id, count(*)::INTEGER AS filled FROM d GROUP BY id)
SELECT conv_id, turn,
  CASE role WHEN 'user' THEN 'accepted' WHEN 'assistant' THEN 'malformed_json' ELSE 'missing_text' END AS status,
  CASE WHEN role = 'user' THEN length(text)::INTEGER END AS text_length,
  CASE WHEN role = 'user' THEN {DIM} END AS width,
  CASE WHEN role = 'user' THEN filled END AS filled
FROM conversations LEFT JOIN filled ON filled.id = conv_id || '/' || turn""",
        "p1_select_star_plus": f"""WITH {_hash_sql('d', 'documents', 'doc_id')},
sums AS (
  SELECT id, sum(sign(x)::BIGINT * (bucket + 1))::BIGINT AS signed_places,
    round(CASE WHEN count(*) < {DIM} THEN greatest(max(x), 0) ELSE max(x) END, 6) + 0.0 AS largest FROM d GROUP BY id)
SELECT documents.*, {DIM} AS embedded_text, signed_places, largest FROM documents LEFT JOIN sums ON id = doc_id""",
        "p3_to_vector": """SELECT vec_id, len(embedding::FLOAT[64])::INTEGER AS width,
  round((embedding::FLOAT[64])[64]::DOUBLE, 6) + 0.0 AS last FROM embeddings""",
        "p4_text_only": f"WITH {one}\nSELECT text FROM ranked JOIN documents ON doc_id = did",
        "p5_question_parameter": f"WITH {one}\nSELECT did AS doc_id, distance FROM ranked",
        "e1_embed": _constant_widths(384),
        "e2_embed_jina": _constant_widths(768),
        "e3_batch_invariance": "SELECT conv_id, turn, true AS same FROM conversations",
        "e4_tokenize": f"""WITH {_tokens_sql('w', 'conversations', 'conv_id')},
{vocabulary},
pieces AS (
  SELECT doc_id, t, pos FROM (
    SELECT doc_id, unnest(list_filter({split}, lambda t: t <> '')) AS t,
           generate_subscripts(list_filter({split}, lambda t: t <> ''), 1) AS pos FROM documents)),
rows_of AS (
  SELECT doc_id, string_agg(coalesce(id, 1)::VARCHAR, ' ' ORDER BY pos) AS ids
  FROM pieces LEFT JOIN words USING (t) GROUP BY doc_id)
SELECT doc_id, ({length})::INTEGER AS n_tokens, concat_ws(' ', '2', ids, '3') AS ids
FROM documents LEFT JOIN rows_of USING (doc_id)""",
        "e5_length_groups": f"SELECT ({length})::INTEGER AS n_tokens, count(*) AS texts FROM documents GROUP BY 1",
        "e8_mean_pool": pooled("1.0::DOUBLE"),
        "e8_masked_mean_pool": pooled("(vec_id % 3 <> 0)::INTEGER::DOUBLE"),
        "e8_mean_pool_rows": """SELECT vec_id, pos,
  round((sum(x * m) / greatest(sum(m), 1e-8))::FLOAT::DOUBLE, 6) + 0.0 AS value
FROM (SELECT vec_id, (i - 1)::INTEGER % 8 AS pos, x, (((i - 1) // 8 + vec_id) % 3 <> 0)::INTEGER::DOUBLE AS m
      FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings))
GROUP BY vec_id, pos""",
        "e9_l2_normalize": """SELECT vec_id, generate_subscripts(v, 1)::INTEGER - 1 AS pos,
  round((unnest(v) / sqrt(list_sum(list_transform(v, lambda x: x * x))))::FLOAT::DOUBLE, 6) + 0.0 AS value
FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 2 + 1) AS v FROM embeddings)""",
        "e11_valid_text": "SELECT doc_id, '<' || chr(65533) || text || chr(65533) AS text FROM documents",
        "e13_hash_vectors": hashed,
        "e13_distinct_texts": hashed,
        "v1_array_distance": f"""WITH {vectors}
SELECT a.vec_id, {distance.format(a='a.v', b='b.v')} AS distance
FROM vectors a JOIN vectors b ON b.vec_id = a.vec_id + 1""",
        "v2_vector_width": "SELECT vec_id, len(embedding)::INTEGER AS width FROM embeddings",
        "k1_topk": f"""WITH {vectors},
center AS MATERIALIZED (
  SELECT list(x ORDER BY pos) AS c FROM (
    SELECT pos, avg(x)::FLOAT::DOUBLE AS x
    FROM (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM vectors) GROUP BY pos))
SELECT vec_id, label, {distance.format(a='v', b='c')} AS distance
FROM vectors CROSS JOIN center ORDER BY distance, vec_id LIMIT 10""",
        "k2_topk_vectors": nearest,
        "k2_topk_in_blocks": nearest,
        "k3_cells_all_probes": nearest,
        "k2_topk_documents": f"""WITH {asked}
SELECT qid AS item_id, rank, did AS doc_id, length(text)::INTEGER AS text_length, distance
FROM ranked JOIN documents ON doc_id = did""",
        "k3_many_cells": f"""WITH {vectors}
SELECT vec_id, place, cell FROM (
  SELECT a.vec_id, b.vec_id::INTEGER AS cell,
    (row_number() OVER (PARTITION BY a.vec_id ORDER BY {distance.format(a='a.v', b='b.v')}, b.vec_id) - 1)::INTEGER AS place
  FROM vectors a JOIN vectors b ON b.vec_id % 10 = 0)
WHERE place < 3""",
        "k3_cells": in_cells,
        "k3_cells_appended": in_cells,
        "k3_recall_curve": curve,
        "k4_lsh_join": near,
        "k4_lsh_join_shuffled": near,
        "k4_lsh_self_join": near.replace(
            vectors, "vectors AS MATERIALIZED (SELECT min(vec_id) AS vec_id, embedding::DOUBLE[] AS v FROM embeddings GROUP BY v)"
        ),
        "k5_retrieve": retrieved,
        "k5_retrieve_cells": retrieved,
        "t1_embed_stream": f"""WITH {_hash_sql('d', 'conversations', "conv_id || '/' || turn")}
SELECT conv_id, turn, CASE WHEN text IS NOT NULL THEN {DIM} END AS width, bucket::INTEGER AS bucket,
  round(x, 6) + 0.0 AS value
FROM conversations LEFT JOIN d ON d.id = conv_id || '/' || turn AND round(x, 6) <> 0""",
        "t1_stream_requests": f"""WITH {_hash_sql('d', 'conversations', "conv_id || '/' || turn")},
asked AS (
  SELECT conv_id || '/' || turn AS id,
    CASE role WHEN 'user' THEN CASE WHEN length(text) % 5 = 0 THEN 'unknown_model' ELSE 'answered' END
      WHEN 'assistant' THEN 'malformed_json' ELSE 'missing_text' END AS status FROM conversations)
SELECT CASE WHEN status = 'malformed_json' THEN 'broken ' ELSE '' END || asked.id AS request, status,
  bucket::INTEGER AS bucket, round(x, 6) + 0.0 AS value
FROM asked LEFT JOIN d ON d.id = asked.id AND status = 'answered' AND round(x, 6) <> 0""",
        "t2_route_requests": """SELECT text, CASE WHEN role = 'assistant' THEN 'embed' ELSE 'embed_jina' END AS model,
  CASE WHEN role = 'assistant' THEN 384 ELSE 768 END AS width FROM conversations""",
        "t2_route_hashes": f"""WITH {_hash_sql('n', "(SELECT * FROM conversations WHERE role = 'assistant')", "conv_id || '/' || turn", dim=ROUTES['narrow'])},
{_hash_sql('d', "(SELECT * FROM conversations WHERE role = 'user')", "conv_id || '/' || turn", dim=ROUTES['wide'])},
both_widths AS (SELECT id, bucket, x FROM n UNION ALL SELECT id, bucket, x FROM d),
asked AS (
  SELECT conv_id || '/' || turn AS id, CASE role WHEN 'assistant' THEN 'narrow' ELSE 'wide' END AS model
  FROM conversations WHERE role IN ('assistant', 'user') AND text IS NOT NULL)
SELECT asked.id, model, CASE model WHEN 'narrow' THEN {ROUTES['narrow']} ELSE {ROUTES['wide']} END AS width,
  bucket::INTEGER AS bucket, round(x, 6) + 0.0 AS value
FROM asked LEFT JOIN both_widths b ON b.id = asked.id AND round(x, 6) <> 0""",
        "u1_registered_functions": "SELECT item_id, 384 AS width, 768 AS width_jina FROM benchmark",
    } | _training_data_sql()
