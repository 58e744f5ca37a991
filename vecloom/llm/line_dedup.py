"""Operator 5: removal of boilerplate lines by the number of distinct sites they stand on.

A line is boilerplate when it stands on at least `min_sites` different sites. A page counts for one
site only, so a page that is copied from site to site does not make all its lines boilerplate: the line
must stand on as many different pages too. Pages are the same when their longest line, that line
itself aside, is the same; so near copies mostly count as one page as well. Copies are the
business of near-duplicate removal.

Spread is first estimated: HyperLogLog sketches of sites and of pages are built for each
line hash and merged by partial aggregation, so a line of a third of all rows costs one sketch
for each task. Lines well below or above the threshold are decided by the estimate; those whose
estimate is within `BAND` of it are counted exactly. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.session import materialize

SKETCH_BITS = 10  # a sketch has a relative error of about 3 percent, and is exact for small counts
BAND = 0.25


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _key(row: DataFrame, columns: list[str]) -> Column:
    """Equal rows have equal keys, and the same lines removed. 128 bits, as two numbers."""
    null_marks = [F.col(c).isNull() for c in columns]
    parts = [*columns, *null_marks]
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("x"), F.xxhash64(*parts, F.lit(2)).alias("y"))


def line_spread(docs: DataFrame, text: str = "text", site: str = "source") -> DataFrame:
    """One row for each line of each document: (key, pos, line, site, page).

    `line` is a hash of the trimmed line, `page` one of the longest other line of the text (of equally
    long ones the greatest). Blank lines are left out. NULL sites are one site.
    """
    trimmed = F.transform(_lines(F.col(text)), lambda x: F.trim(x))
    sized = docs.select(
        _key(docs, [text, site]).alias("key"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.transform(trimmed, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))).alias("all"),
    ).withColumn("top", F.array_max("all"))
    second = F.array_max(F.filter("all", lambda x: x != F.col("top")))
    hashed = sized.select(
        "key",
        "site",
        F.transform("all", lambda x: F.xxhash64(x["x"])).alias("lines"),
        F.xxhash64("top.x").alias("longest"),
        F.xxhash64(F.coalesce(second["x"], F.lit(""))).alias("second"),
    )
    flat = hashed.select("key", "site", "longest", "second", F.posexplode("lines").alias("pos", "line"))
    page = F.when(F.col("line") == F.col("longest"), F.col("second")).otherwise(F.col("longest"))
    return flat.where(F.col("line") != F.xxhash64(F.lit(""))).select("key", "pos", "line", "site", page.alias("page"))


def boilerplate(spread: DataFrame, min_sites: int) -> DataFrame:
    """(line) of those of `spread` that are boilerplate."""
    sketched = spread.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"),
        F.hll_sketch_estimate(F.hll_sketch_agg("page", F.lit(SKETCH_BITS))).alias("pages"),
    )
    at_least = lambda share: F.least("sites", "pages") >= min_sites * share
    spreading = materialize(sketched.where(at_least(1 - BAND)), "line-spread")
    clear = at_least(1 + BAND)
    near = spreading.where(~clear).select("line")
    # Two steps of counting, so that a frequent line is first cut to its different values.
    kinds = spread.join(near, "line").select(
        "line", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.xxhash64("site").alias("v")),
                                  F.struct(F.lit(1).alias("kind"), F.col("page").alias("v")))).alias("s")
    )
    counts = kinds.select("line", "s.*").distinct().groupBy("line").agg(
        F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).alias("sites"),
        F.sum(F.when(F.col("kind") == 1, 1).otherwise(0)).alias("pages"),
    )
    exact = counts.where(F.least("sites", "pages") >= min_sites)
    return spreading.where(clear).select("line").unionByName(exact.select("line"))


def remove_boilerplate(
    docs: DataFrame,
    text: str = "text",
    site: str = "source",
    min_sites: int = 10,
    n_lines: str = "n_lines",
    n_removed: str = "n_removed",
) -> DataFrame:
    """`docs` with boilerplate lines taken out of `text`, and `n_lines`, `n_removed` (int) added.

    The other lines stay as they are, in order, joined by newlines. Every row stays, with an
    empty text if all its lines went; a NULL text stays NULL with 0 lines (an empty text is one
    blank line). Repeated rows are treated alike. All columns stay; give other names to the added ones
    where the table has them already, which is an error. An empty table gives no rows.
    """
    clash = {n_lines, n_removed} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; choose other output names")
    spread = line_spread(docs, text, site)
    lines = materialize(boilerplate(spread, min_sites), "boilerplate")
    hits = spread.join(lines, "line").groupBy("key").agg(F.collect_set("pos").alias("gone"))
    hits = materialize(hits, "boilerplate-places").select(F.col("key").alias("__key"), F.col("gone").alias("__gone"))
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    joined = docs.select(own, _key(docs, [text, site]).alias("__key")).join(hits, "__key", "left")
    body = F.col("__row")[text]
    all_lines = _lines(body)
    kept = F.filter(all_lines, lambda _, i: ~F.array_contains("__gone", i))
    cleaned = F.when(F.col("__gone").isNull(), body).otherwise(F.array_join(kept, "\n"))
    count = F.when(body.isNull(), 0).otherwise(F.size(all_lines))
    return joined.select(
        *(cleaned.alias(c) if c == text else F.col("__row")[c].alias(c) for c in docs.columns),
        count.alias(n_lines),
        F.coalesce(F.size("__gone"), F.lit(0)).alias(n_removed),
    )
