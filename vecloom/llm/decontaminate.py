"""Operator 2: benchmark decontamination by greedy string tiling.

1. Seeds. Of every run of SEED-word n-grams that a match of `min_match` words contains, the one
   with the least hash is kept on both sides, so a document and a test item that share
   `min_match` words in a row share a seed. Documents' seeds are joined with the items'.
2. Tiling. Each candidate pair is tiled: Karp-Rabin hashes of all unmarked places of one length
   find the longest common runs, which are marked, longest first and without overlap; then the
   length is halved, down to `min_match`. Order is free, so moved passages count.
3. An item whose tiles cover at least `min_coverage` of its words is leaked into the document.

Documents are scanned where they lie; only seed hits and the texts of candidates move. The
items' seeds are broadcast only up to `BROADCAST_SEEDS` (16 bytes each) and otherwise joined.
An item in a third of all documents makes one row for each of them, each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vecloom.llm.repeats import _sliding
from vecloom.llm.wordhash import U64, ngrams, slices, whole
from vecloom.session import materialize, ship_package

SEED = 5
MIN_MATCH = 8
MIN_COVERAGE = 0.5
BROADCAST_SEEDS = 2_000_000


def _seeds(words, hashes: np.ndarray, min_match: int, short: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(text, seed) of some texts, with repeats. `short`: lengths of items under `min_match` words."""
    grams = ngrams(hashes, SEED)
    span = min_match - SEED + 1
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0, U64)]
    inside = whole(words, min_match)
    if inside.any():
        least = _sliding(grams, span, np.minimum)
        rows.append(words.row[: len(least)][inside])
        found.append(least[inside])
    for n in short:
        inside = whole(words, n)
        own = ngrams(hashes, n) ^ U64(n)
        rows.append(words.row[: len(own)][inside])
        found.append(own[inside])
    rows, found = np.concatenate(rows), np.concatenate(found)
    if not len(rows):
        return rows, found
    # Neighbouring windows mostly name the same seed.
    new = np.r_[True, (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])]
    return rows[new], found[new]


def _seed_rows(table: DataFrame, kind, min_match: int, short: list[int] | None) -> DataFrame:
    """(id, seed) of a table (id, text). With `short` None each row takes its own length, if short."""
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["id"].cast(arrow)
            for low, _, words in slices(batch["text"], True):
                hashes = words.hashes()
                if short is not None:
                    rows, seeds = _seeds(words, hashes, min_match, short)
                else:
                    rows, seeds = _seeds(words, hashes, min_match, [])
                    for row in np.flatnonzero((words.count > 0) & (words.count < min_match)):
                        n = int(words.count[row])
                        part = ngrams(hashes[words.first[row] : words.first[row + 1]], n) ^ U64(n)
                        rows, seeds = np.append(rows, row), np.append(seeds, part)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows + low)), pa.array(seeds.view(np.int64))], names=["id", "seed"]
                )

    return table.mapInArrow(run, f"id {kind.simpleString()}, seed long")


def tiles(a: np.ndarray, b: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """(place in a, place in b, length) of a greedy tiling of two arrays of word hashes."""
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    low = min(min_match, len(b)) or 1
    length = max(low, 1 << max(0, len(b).bit_length() - 1))
    out: list[tuple[int, int, int]] = []
    while True:
        matches = []
        if length <= min(len(a), len(b)):
            whole_a = np.lib.stride_tricks.sliding_window_view(free_a, length).all(axis=1)
            whole_b = np.lib.stride_tricks.sliding_window_view(free_b, length).all(axis=1)
            rolled_a, rolled_b = ngrams(a, length), ngrams(b, length)
            places: dict[int, list[int]] = {}
            for j in np.flatnonzero(whole_b).tolist():
                places.setdefault(int(rolled_b[j]), []).append(j)
            common = np.flatnonzero(whole_a & np.isin(rolled_a, rolled_b[whole_b]))
            for i in common.tolist():
                for j in places[int(rolled_a[i])]:
                    if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                        continue  # part of a match that begins earlier
                    n = length
                    while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                        n += 1
                    matches.append((-n, i, j))
        marked = False
        for n, i, j in sorted(matches):
            if free_a[i : i - n].all() and free_b[j : j - n].all():
                free_a[i : i - n] = free_b[j : j - n] = False
                out.append((i, j, -n))
                marked = True
        if marked:
            continue  # what overlapped a tile may still match in part
        if length == low:
            return sorted(out)
        length = max(low, length // 2)


def _tile_rows(min_match: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("doc_word", pa.int32()), ("item_word", pa.int32()), ("words", pa.int32())]))
        for batch in batches:
            found, sizes = [], []
            for x, y in zip(batch["text"], batch["item_text"], strict=True):
                own = [
                    np.concatenate([w.hashes() for _, _, w in slices(pa.array([t.as_py()], pa.string()), True)])
                    for t in (x, y)
                ]
                sizes.append(len(own[1]))
                found.append(
                    [{"doc_word": i, "item_word": j, "words": n} for i, j, n in tiles(own[0], own[1], min_match)]
                )
            keep = [batch["id"], batch["item_id"], pa.array(sizes, pa.int64()), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(keep, names=["id", "item_id", "item_words", "tiles"])

    return run


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text: str = "text",
    min_match: int = MIN_MATCH,
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """(doc_id, item_id, item_words, covered, coverage, tiles): which documents hold which items.

    Words are what stands between white space, A-Z lower-cased. An item of fewer than
    `min_match` words counts only where it stands whole. Items and documents that are NULL or
    wordless hold nothing. Rows that repeat give one result row (ids, with their texts, are taken
    as sets); NULL ids stay NULL. Other columns are ignored; empty tables give no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    doc_kind, item_kind = docs.schema[id_col].dataType, items.schema[item_col].dataType
    left = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    right = items.select(F.col(item_col).alias("id"), F.col(text).alias("text")).distinct()
    item_seeds = materialize(_seed_rows(right, item_kind, min_match, None).distinct(), "item-seeds")
    n_words = F.regexp_count(F.col("text"), F.lit("[^\\x20\\x09-\\x0D]+"))
    short = right.select(n_words.alias("n")).where((F.col("n") > 0) & (F.col("n") < min_match)).distinct()
    lengths = sorted(r["n"] for r in short.collect())  # at most min_match - 1 numbers
    item_seeds = item_seeds.withColumnRenamed("id", "item_id")
    n_seeds = item_seeds.count()
    side = F.broadcast(item_seeds) if n_seeds <= BROADCAST_SEEDS else item_seeds
    hits = _seed_rows(left, doc_kind, min_match, lengths).join(side, "seed").select("id", "item_id").distinct()
    hits = materialize(hits, "seed-hits")
    texts = right.withColumnsRenamed({"id": "item_id", "text": "item_text"})
    pairs = (
        left.join(hits.withColumnRenamed("id", "hit"), left["id"].eqNullSafe(F.col("hit")))
        .join(texts.withColumnRenamed("item_id", "own"), F.col("item_id").eqNullSafe(F.col("own")))
        .where(F.col("text").isNotNull() & F.col("item_text").isNotNull())
        .select("id", "text", "item_id", "item_text")
        .distinct()
    )
    schema = (
        f"id {doc_kind.simpleString()}, item_id {item_kind.simpleString()}, item_words long, "
        "tiles array<struct<doc_word:int,item_word:int,words:int>>"
    )
    tiled = pairs.mapInArrow(_tile_rows(min_match), schema)
    covered = F.aggregate("tiles", F.lit(0).cast("long"), lambda s, t: s + t["words"])
    counted = tiled.withColumn("covered", covered).where(F.col("covered") >= F.col("item_words") * min_coverage)
    return counted.where("covered > 0").select(
        F.col("id").alias(id_col),
        F.col("item_id").alias(item_col),
        "item_words",
        "covered",
        (F.col("covered") / F.col("item_words")).alias("coverage"),
        "tiles",
    )
