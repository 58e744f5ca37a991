"""A training corpus from `documents`: five stages, each written as Parquet and read again.

1. language: documents whose language can't be told go.
2. lines: boilerplate lines that stand on many sites go.
3. near copies: one document of each group of similar ones stays.
4. benchmark: documents that hold a test item go.
5. tokens: ids of every text are added.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm.bpe import encode
from vecloom.llm.decontaminate import leaks
from vecloom.llm.language_id import identify, train
from vecloom.llm.line_dedup import remove_boilerplate
from vecloom.llm.ngram_join import one_of_each
from vecloom.session import materialize


def _free(docs: DataFrame, name: str) -> str:
    """`name`, or a longer one that no column of `docs` has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10, learned from the labelled documents themselves; rejected ones go."""
    names = {name: _free(docs, name) for name in ("lang_pred", "score", "rejected")}
    found = identify(docs, train(docs), names=names)
    return found.where(~F.col(names["rejected"])).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5; every document stays, and n_chars follows its text."""
    n_lines, n_removed = _free(docs, "n_lines"), _free(docs, "n_removed")
    cleaned = remove_boilerplate(docs, n_lines=n_lines, n_removed=n_removed)
    n_chars = F.when(F.col(n_removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return cleaned.withColumn("n_chars", n_chars).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8 with five words and 80 percent; the smallest id of a group stays."""
    return one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2 against the `benchmark` table."""
    # Ids may be NULL or repeat, so a row is told by its id and text. Equal rows leak alike.
    own = _free(docs, "__hash")
    hashed = docs.withColumn(own, F.xxhash64("text"))
    keyed = hashed.select(F.struct("doc_id", own).alias("key"), "text")
    found = leaks(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="key")
    id_name, hash_name = _free(docs, "leaked_id"), _free(docs, "leaked_hash")
    leaked = materialize(found.select("key.*").distinct(), "leaked").toDF(id_name, hash_name)
    same = hashed["doc_id"].eqNullSafe(F.col(id_name)) & (hashed[own] == F.col(hash_name))
    return hashed.join(leaked, same, "left_anti").drop(own)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4; adds `ids` and `n_tokens`, under longer names where the table has such columns."""
    ids, n_tokens = _free(docs, "ids"), _free(docs, "n_tokens")
    encoded = encode(docs, public_tokenizers.path("word_bpe_49k.json"), out=ids)
    return encoded.withColumn(n_tokens, F.size(ids).cast("long"))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("tokens", tokens),
]

#: Language ID, string tiling and BPE have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
