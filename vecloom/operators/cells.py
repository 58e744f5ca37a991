"""Approximate top-k over a table partitioned by cell (K-3).

Each vector lies in the cell of its nearest centroid, and a question is searched only in the
`nprobe` cells nearest to it. With `nprobe` equal to the number of cells the result is the
exact one, but for rows without a finite vector, which the index keeps in cell -1 and never
searches.

How many cells a wanted recall takes is measured by `calibrate_cells`: the exact neighbours of
some questions are found once and kept with the index. A neighbour in the cell that is r-th nearest to
its question is found by a search of r cells or more and by no smaller one, so this one search gives the
recall at every `nprobe`. Added rows are searched on their own and merged with what is kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecloom.functions.arrow_vectors import matrix_of
from vecloom.functions.vectors import DISTANCE_DIGITS, rank_distance
from vecloom.operators.meet import meet
from vecloom.operators.scoring import QuestionBlock, first_per_group, pair_distances, squared_products
from vecloom.operators.topk import search, topk_batch
from vecloom.session import materialize, ship_package

CENTROID_BYTES = 256 << 20
PIECE_BYTES = 12 << 20  # vectors of a cell, or questions, in one piece: bounds a task's memory and its longest step
PROBE_BYTES = 16 << 20  # questions of one broadcast, which every Python worker holds with their cells
NO_CELL = -1
CALIBRATION_ROWS = 1000  # rows of the index that calibrate it where no questions are given


@dataclass(frozen=True)
class CellIndex:
    """A written cell table: `path`/rows partitioned by `cell`, and `path`/centroids."""

    path: str
    key: str
    vec: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")

    def centroids(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/centroids")

    def calibration(self, spark: SparkSession) -> tuple[DataFrame, DataFrame] | None:
        """Questions (qid, vec, k) and neighbours (qid, rank, key, distance, place, load) of the last calibration."""
        try:
            found = spark.read.parquet(f"{self.path}/calibration/found")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        load = found.agg(F.max("load")).first()[0]
        asked = spark.read.parquet(f"{self.path}/calibration/asked")
        return asked.where(F.col("load") == load).drop("load"), found.where(F.col("load") == load)


def fit_centroids(
    df: DataFrame, vec: str, n_cells: int, seed: int = 42, rows_per_cell: int | None = None, iterations: int = 10
) -> DataFrame:
    """K-means centroids as (cell, centroid).

    Trains on all rows, or on a sample of about `rows_per_cell` rows for each cell if that is given. Centroids
    only decide where rows are stored: `build_cells` places every row whatever they are, so
    a sample changes how even the cells are and nothing else.
    """
    if rows_per_cell is not None:
        share = n_cells * rows_per_cell / max(df.count(), 1)
        df = df.sample(fraction=share, seed=seed) if share < 1 else df
    rows = df.select(F.col(vec).cast("array<double>").alias("v")).where("v IS NOT NULL")
    rows = rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x)))
    model = KMeans(k=n_cells, seed=seed, maxIter=iterations, featuresCol="f").fit(
        rows.select(array_to_vector("v").alias("f"))
    )
    centers = [(number, [float(x) for x in center]) for number, center in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(centers, "cell int, centroid array<double>")


def _centroid_table(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Centroids as arrays on the driver; their count is a setting, and callers check it."""
    table = centroids.select(F.col("cell").cast("int"), "centroid").toArrow().combine_chunks().sort_by("cell")
    if not table.num_rows:
        raise ValueError("no centroids")
    matrix, rows = matrix_of(table.column(1).combine_chunks())
    if len(rows) < table.num_rows or not np.isfinite(matrix).all():
        raise ValueError("centroids must be finite vectors")
    return np.asarray(table.column(0)), matrix


def _fit_broadcast(centroids: DataFrame) -> bool:
    size = centroids.agg(F.count("*").alias("n"), F.max(F.array_size("centroid")).alias("width")).first()
    return size["n"] * (size["width"] or 0) * 8 <= CENTROID_BYTES


def _finite(vec: str):
    return F.col(vec).isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def nearest_cells(spark: SparkSession, centroids: DataFrame, n: int = 1):
    """Arrow UDF `vector -> array<int>`: its n nearest cells, nearest first; ties by cell number.

    A vector that is NULL or not finite has no cells. Centroids go out as one broadcast; `with_cells` takes
    any number of them.
    """
    if not _fit_broadcast(centroids):
        raise ValueError(f"the centroids need more than {CENTROID_BYTES} bytes; use with_cells")
    ship_package(spark)
    cells, centers = _centroid_table(centroids)
    shared = spark.sparkContext.broadcast((cells, _Centers(centers)))

    @F.arrow_udf("array<int>")
    def cells_of(vectors: pa.Array) -> pa.Array:
        cells, centers = shared.value
        matrix, rows = matrix_of(vectors, centers.matrix.shape[1])
        finite = np.isfinite(matrix).all(axis=1)
        take = min(n, len(cells))
        found = np.empty((int(finite.sum()), take), dtype=np.int32)
        step = max(1, (1 << 22) // len(cells))
        good = matrix[finite]
        for at in range(0, len(good), step):
            found[at : at + step] = cells[centers.nearest(good[at : at + step], take)]
        counts = np.zeros(len(vectors), dtype=np.int32)
        counts[rows[finite]] = take
        return pa.ListArray.from_arrays(np.r_[0, np.cumsum(counts)].astype(np.int32), pa.array(found.reshape(-1)))

    return cells_of


def with_cells(df: DataFrame, vec: str, out: str, centroids: DataFrame, n: int = 1) -> DataFrame:
    """`df` with `out array<int>`: the n nearest cells of each vector, as `nearest_cells` gives them.

    A vector that is NULL or not finite has none: an empty array. Centroids beyond a broadcast meet the rows in
    pieces, as a question table meets a corpus (`topk_batch`); then the rows are written once, numbered, and
    their cells are joined back by number.
    """
    if _fit_broadcast(centroids):
        cells = nearest_cells(df.sparkSession, centroids, n)
        return df.withColumn(out, F.coalesce(cells(vec), F.array().cast("array<int>")))
    odd = centroids.where(~_finite("centroid")).limit(1).count()
    if odd:
        raise ValueError("centroids must be finite vectors")
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    corpus = centroids.select(F.col("cell").cast("int").alias("cell"), "centroid")
    asked = rows.where(_finite(vec)).select("_row", F.col(vec).alias("_vec"))
    found = topk_batch(corpus, asked, min(n, max(1, centroids.count())), "cell", "centroid", "_row", "_vec")
    ranked = F.sort_array(F.collect_list(F.struct("rank", "cell")))  # n cells a row
    own = found.groupBy("_row").agg(F.transform(ranked, lambda x: x["cell"]).alias("_own"))
    cells = F.coalesce("_own", F.array().cast("array<int>"))
    return rows.join(own, "_row", "left").withColumn(out, cells).drop("_row", "_own")


class _Centers:
    """Centers in two levels: groups of centers that lie near each other, each with a head and a radius.

    A row's distance to a center is at least that to its head less the radius. So a row is first compared with
    the heads and with the nearest head's own centers, and after that only with groups that may hold a nearer
    one. The result is that of `_nearest` for all rows. Where most groups may, as with vectors that are
    all equally far apart, one product with all centers is cheaper and is taken.
    """

    def __init__(self, matrix: np.ndarray, least: int = 1024):
        self.matrix, self.members = matrix, []
        if len(matrix) < least:
            return
        heads = matrix[np.linspace(0, len(matrix) - 1, int(len(matrix) ** 0.5)).astype(int)].astype(np.float64)
        for _ in range(4):
            own = _nearest(matrix, heads, 1)[:, 0]
            filled = np.unique(own)
            heads = np.stack([matrix[own == h].mean(axis=0) for h in filled])
        own = _nearest(matrix, heads, 1)[:, 0]
        far = pair_distances(matrix, heads, np.arange(len(matrix)), own)
        filled = np.unique(own)
        self.heads = heads[filled]
        self.members = [np.flatnonzero(own == h) for h in filled]
        self.radius = np.array([far[m].max() for m in self.members]) * (1 + 1e-9)

    def nearest(self, matrix: np.ndarray, take: int) -> np.ndarray:
        if not self.members or 8 * take > len(self.matrix):
            return _nearest(matrix, self.matrix, take)
        squares, slack = squared_products(matrix, self.heads)
        squares, slack = squares.astype(np.float64), slack[:, None]
        low = np.sqrt(np.maximum(squares - slack, 0.0)) - self.radius
        high = np.sqrt(np.maximum(squares + slack, 0.0)) + self.radius
        # So near are `take` centers at least: the groups with the least upper bounds hold as many.
        sizes, order = np.array([len(m) for m in self.members]), np.argsort(high, axis=1)
        reached = np.argmax(np.cumsum(sizes[order], axis=1) >= take, axis=1)
        limit = np.take_along_axis(high, order, axis=1)[np.arange(len(matrix)), reached]
        first, found = np.argmin(squares, axis=1), []

        def look(group: int, rows: np.ndarray) -> None:
            """Offer the centers of a group to rows, and lower their limits."""
            members = self.members[group]
            near, error = squared_products(matrix[rows], self.matrix[members])
            near, error = near.astype(np.float64), error[:, None]
            if len(members) >= take:
                kth = np.partition(np.sqrt(np.maximum(near + error, 0.0)), take - 1, axis=1)[:, take - 1]
                limit[rows] = np.minimum(limit[rows], kth)
            least = np.sqrt(np.maximum(near - error, 0.0))
            q, c = np.nonzero(least <= limit[rows, None] + 10.0**-DISTANCE_DIGITS)
            found.append((rows[q], members[c], least[q, c]))

        for group in np.unique(first):
            look(group, np.flatnonzero(first == group))
        maybe = low <= limit[:, None] + 10.0**-DISTANCE_DIGITS
        maybe[np.arange(len(matrix)), first] = False
        if len(matrix) and maybe.mean() > 0.5:
            return _nearest(matrix, self.matrix, take)
        for group in np.flatnonzero(maybe.any(axis=0)):
            look(group, np.flatnonzero(maybe[:, group]))
        q, c, least = (np.concatenate(part) for part in zip(*found, strict=True)) if found else [np.zeros(0, int)] * 3
        still = least <= limit[q] + 10.0**-DISTANCE_DIGITS
        return _first(matrix, self.matrix, q[still], c[still], take)


def _first(matrix: np.ndarray, centers: np.ndarray, q: np.ndarray, c: np.ndarray, take: int) -> np.ndarray:
    """The first `take` centers of each row among the pairs (q, c), measured in double precision."""
    distance = np.round(pair_distances(matrix, centers, q, c), DISTANCE_DIGITS)
    order = np.lexsort((c, distance, q))
    order = order[first_per_group(q[order], take)]
    return c[order].reshape(len(matrix), take)


def _nearest(matrix: np.ndarray, centers: np.ndarray, take: int) -> np.ndarray:
    """Positions of the `take` nearest centers of each row, by distance rounded for ranking, then position.

    Products in single precision with an error bound pick the few that may be among them; only
    those are measured in double precision and sorted.
    """
    squares, slack = squared_products(matrix, centers)
    kth = np.partition(squares, take - 1, axis=1)[:, take - 1]
    bound = (np.sqrt(np.maximum(kth + slack, 0.0)) + 10.0**-DISTANCE_DIGITS) ** 2 + slack
    q, c = np.nonzero(squares <= np.nextafter(bound.astype(squares.dtype), squares.dtype.type(np.inf))[:, None])
    return _first(matrix, centers, q, c, take)


def build_cells(df: DataFrame, key: str, vec: str, path: str, centroids: DataFrame) -> CellIndex:
    """Write `df` partitioned by cell under `path`, with all its columns.

    Rows are gathered by cell before writing, and adaptive execution splits the cells that
    are larger than one write task, so a cell with a third of the table is written in parallel.
    """
    centroids.select(F.col("cell").cast("int"), "centroid").coalesce(1).write.parquet(f"{path}/centroids")
    index = CellIndex(path, key, vec)
    _place(df, index, centroids, "errorifexists")
    return index


def append_cells(df: DataFrame, index: CellIndex) -> None:
    """Add rows to a built index, each in the cell of its nearest centroid; nothing is rebuilt.

    Rows have the columns of the index. Searches that begin later see them. Keys must be new.
    A calibrated index stays calibrated: its questions are searched in the new rows only.
    """
    spark = df.sparkSession
    known = [name for name in index.rows(spark).columns if name != "cell"]
    df, kept = df.select(*known), index.calibration(spark)
    if kept is not None:
        df = materialize(df, "added")  # read twice from here on
    _place(df, index, index.centroids(spark), "append")
    if kept is not None:
        asked, found = kept
        fresh = _neighbours(spark, index, df, asked)
        _keep_calibration(spark, index, asked, found.drop("load", "rank").unionByName(fresh))


def _place(df: DataFrame, index: CellIndex, centroids: DataFrame, mode: str) -> None:
    placed = with_cells(df, index.vec, "_cells", centroids)
    placed = placed.withColumn("cell", F.coalesce(F.get("_cells", F.lit(0)), F.lit(NO_CELL))).drop("_cells")
    placed.hint("rebalance", "cell").write.mode(mode).partitionBy("cell").parquet(f"{index.path}/rows")


def calibrate_cells(
    spark: SparkSession,
    index: CellIndex,
    k: int = 10,
    questions: DataFrame | None = None,
    qid: str = "qid",
    qvec: str = "embedding",
    sample: int = CALIBRATION_ROWS,
) -> None:
    """Measure the recall of the k nearest at every `nprobe` and keep it with the index.

    `questions` should be a sample of those to be asked; without any, `sample` rows of the index
    (those of the least key hashes) ask for their neighbours other than themselves. Questions without a
    finite vector take no part. Costs one exact search; calling it again replaces the last one.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if questions is None:
        own = index.rows(spark).where(F.col("cell") != NO_CELL)
        asked = own.select(F.col(index.key).alias("qid"), F.col(index.vec).alias("vec"))
        asked = asked.orderBy(F.xxhash64("qid"), "qid").limit(sample)
    else:
        asked = questions.select(F.col(qid).alias("qid"), F.col(qvec).alias("vec"))
        asked = asked.where(_finite("vec"))
    asked = materialize(asked.withColumn("k", F.lit(k)), "calibration")
    found = _neighbours(spark, index, index.rows(spark), asked, but_itself=questions is None)
    _keep_calibration(spark, index, asked, found)


def _neighbours(
    spark: SparkSession, index: CellIndex, rows: DataFrame, asked: DataFrame, but_itself: bool = False
) -> DataFrame:
    """(qid, key, distance, place) of the exact neighbours; `place` numbers a question's cells, nearest first."""
    centroids = index.centroids(spark)
    rows = rows.select(F.col(index.key).alias("key"), F.col(index.vec).alias("vec"))
    k = (asked.agg(F.max("k")).first()[0] or 1) + but_itself
    found = topk_batch(rows, asked.select("qid", "vec"), k, "key", "vec", "qid", "vec")
    if but_itself:
        found = found.where(F.col("key") != F.col("qid"))
    # Only the vectors of what was found are placed, and no question's cells leave the task that numbers them.
    found = materialize(found.select("qid", "key", "distance"), "neighbours")
    placed = with_cells(found.join(rows, "key"), "vec", "_cells", centroids)
    placed = placed.select("qid", "key", "distance", F.get("_cells", F.lit(0)).alias("cell"))
    hits = placed.where("cell IS NOT NULL").groupBy("qid").agg(F.collect_list(F.struct("key", "distance", "cell")).alias("hits"))
    numbered = with_cells(asked.join(hits, "qid"), "vec", "cells", centroids, np.iinfo(np.int32).max)
    place = F.transform(
        "hits",
        lambda h: F.struct(h["key"].alias("key"), h["distance"].alias("distance"),
                           F.array_position("cells", h["cell"]).cast("int").alias("place")),
    )
    return numbered.select("qid", F.inline(place))


def _keep_calibration(spark: SparkSession, index: CellIndex, asked: DataFrame, found: DataFrame) -> None:
    """Write the k nearest of `found` as a new load. One that was cut short is not read, as `found` comes last."""
    order = Window.partitionBy("qid").orderBy(rank_distance("distance").asc_nulls_last(), "key")
    ranked = found.withColumn("rank", F.row_number().over(order)).join(asked.select("qid", "k"), "qid")
    ranked = ranked.where(F.col("rank") <= F.col("k")).drop("k")
    kept = index.calibration(spark)
    load = 0 if kept is None else (kept[1].agg(F.max("load")).first()[0] or 0) + 1
    for name, table in (("asked", asked), ("found", ranked)):
        numbered = table.withColumn("load", F.lit(load))
        mode = "overwrite" if name == "asked" and kept is None else "append"
        numbered.write.mode(mode).parquet(f"{index.path}/calibration/{name}")


def recall_curve(spark: SparkSession, index: CellIndex, k: int | None = None, confidence: float = 0.95) -> DataFrame:
    """(nprobe, expected, hit, recall, sure) of a calibrated index, for each `nprobe` that finds more than one less.

    `recall` is that of the calibrating questions. `sure` is a lower bound of the recall of others
    like them, at the given confidence, from how much it varies from question to question. `k`
    may be smaller than the calibrated one.
    """
    kept = index.calibration(spark)
    if kept is None:
        raise ValueError("the index is not calibrated; call calibrate_cells first")
    asked, found = kept
    most = asked.agg(F.max("k")).first()[0]
    if k is not None and most is not None and not 1 <= k <= most:
        raise ValueError(f"the index is calibrated for k from 1 to {most}, not {k}")
    found = found.where(F.col("rank") <= (k or most or 1))
    size = found.agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("qid").alias("questions")).first()
    # A question's h-th hit takes the square of its number of hits from (h-1)**2 to h**2.
    nth = F.row_number().over(Window.partitionBy("qid").orderBy("place", "rank"))
    hits = found.select("place", nth.alias("h")).groupBy("place")
    steps = hits.agg(F.count(F.lit(1)).alias("n"), F.sum(2 * F.col("h") - 1).alias("s"))
    # At most one row for each cell, or for each neighbour if those are fewer.
    upto = Window.orderBy("place")
    steps = steps.select("place", F.sum("n").over(upto).alias("hit"), F.sum("s").over(upto).alias("squares"))
    questions = float(max(size["questions"], 1))
    mean = F.col("hit") / questions
    spread = F.sqrt(F.greatest(F.col("squares") / questions - mean * mean, F.lit(0.0)) / questions)
    sure = (mean - NormalDist().inv_cdf(confidence) * spread) * questions / float(max(size["hits"], 1))
    return steps.select(
        F.col("place").alias("nprobe"),
        F.lit(size["hits"]).cast("long").alias("expected"),
        "hit",
        (F.col("hit") / F.lit(float(max(size["hits"], 1)))).alias("recall"),
        F.when(F.col("hit") == size["hits"], F.lit(1.0)).otherwise(F.greatest(sure, F.lit(0.0))).alias("sure"),
    )


def nprobe_for(
    spark: SparkSession, index: CellIndex, wanted: float, k: int | None = None, confidence: float = 0.95
) -> int:
    """The least `nprobe` whose recall is `wanted` or more at the given confidence; all cells if none is known."""
    if not 0 < wanted <= 1:
        raise ValueError("a wanted recall is over 0 and at most 1")
    curve = recall_curve(spark, index, k, confidence)
    enough = curve.where(F.col("sure") >= wanted).agg(F.min("nprobe")).first()[0]
    # Finding all that a sample has is no proof for other questions: only all cells are exact.
    return enough if enough is not None and wanted < 1 else index.centroids(spark).count()


def topk_cells(
    spark: SparkSession,
    index: CellIndex,
    questions: DataFrame,
    nprobe: int | None = None,
    k: int = 5,
    qid: str = "qid",
    qvec: str = "embedding",
    max_question_bytes: int = PROBE_BYTES,
    wanted: float | None = None,
) -> DataFrame:
    """Approximate top-k per question: (qid, rank, key, distance).

    In place of `nprobe` a calibrated index takes a `wanted` recall, see `nprobe_for`.
    A question without a finite vector probes no cell and has no results. Only the partitions of
    probed cells are read. Questions of at most `max_question_bytes` are broadcast, and the table is not
    shuffled. More of them are joined with the rows by cell, in one job: see `_by_cell`.
    """
    if (nprobe is None) == (wanted is None):
        raise ValueError("give either nprobe or a wanted recall")
    if nprobe is None:
        nprobe = nprobe_for(spark, index, wanted, k)
    probing = with_cells(questions, qvec, "_cells", index.centroids(spark), nprobe)

    def only_probed(rows: DataFrame, block: QuestionBlock) -> DataFrame:
        probed = {int(cell) for cells in block.cells if cells for cell in cells}
        return rows.where(F.col("cell").isin(sorted(probed)))

    def beyond(stored: DataFrame, need: int) -> DataFrame:
        asked = stored.select(F.col(qid).alias("qid"), F.col(qvec).alias("vec"), F.explode("_cells").alias("cell"))
        return _by_cell(spark, index, asked, k)

    return search(
        index.rows(spark),
        probing,
        k,
        index.key,
        index.vec,
        qid,
        qvec,
        corpus_cell="cell",
        question_cells="_cells",
        max_question_bytes=max_question_bytes,
        for_block=only_probed,
        beyond=beyond,
    )


def _by_cell(spark: SparkSession, index: CellIndex, asked: DataFrame, k: int) -> DataFrame:
    """Partial results of (qid, vec, cell) probes, joined with the rows of their cells.

    Rows and probes of each cell are counted first. A cell with more rows than a piece holds is salted
    over several, and its probes are there once for each; probes that are too many for a piece are
    cut into blocks in the same way, each of which meets all salts. So neither the memory of a piece nor the
    work of one grows with the tables, only their number. The list of cells, which is no longer
    than that of the centroids, is all that goes to the driver.
    """
    asked = materialize(asked, "probes")
    row_bytes = 8 * (index.centroids(spark).select(F.array_size("centroid")).first()[0] or 0) + 64
    most_rows = most_asked = max(1, PIECE_BYTES // row_bytes)
    sizes = index.rows(spark).groupBy("cell").agg(F.count(F.lit(1)).alias("n_rows"))
    probed = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n_asked")).join(sizes, "cell").orderBy("cell")
    plan, n_pieces = [], 0
    for cell, n_asked, n_rows in probed.collect():
        salts, n_blocks = -(-n_rows // most_rows), -(-n_asked // most_asked)
        plan.append((cell, n_pieces, salts, n_blocks))
        n_pieces += salts * n_blocks
    cells = F.broadcast(spark.createDataFrame(plan, "cell int, base long, salts int, blocks int"))
    rows = index.rows(spark).where(F.col("cell").isin([cell for cell, *_ in plan]))
    rows = rows.select(F.col(index.key).alias("key"), F.col(index.vec).alias("vec"), "cell").join(cells, "cell")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts")))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asked = asked.join(cells, "cell").withColumn("block", F.pmod(F.xxhash64("qid"), F.col("blocks")))
    asked = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    piece = (F.col("base") + F.col("block") * F.col("salts") + F.col("salt")).cast("long").alias("piece")
    return meet(asked.select(piece, "qid", "vec"), rows.select(piece, "key", "vec"), max(1, n_pieces), k)


def cell_candidate_ratio(
    spark: SparkSession, index: CellIndex, questions: DataFrame, nprobe: int, qvec: str = "embedding"
) -> DataFrame:
    """One row (pairs, candidates, candidate_ratio): the share of pairs a search looks at."""
    sizes = index.rows(spark).groupBy("cell").agg(F.count("*").alias("size"))
    probing = with_cells(questions, qvec, "_cells", index.centroids(spark), nprobe)
    probed = probing.select(F.explode("_cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("asked"))
    looked = probed.join(sizes, "cell").agg(F.coalesce(F.sum(F.col("asked") * F.col("size")), F.lit(0)).alias("candidates"))
    total = sizes.agg(F.sum("size").alias("n")).first()["n"] or 0
    pairs = total * questions.count()
    ratio = F.col("candidates") / F.lit(float(max(pairs, 1)))
    return looked.select(F.lit(pairs).alias("pairs"), "candidates", ratio.alias("candidate_ratio"))


def recall(found: DataFrame, exact: DataFrame, qid: str, key: str) -> DataFrame:
    """One row (expected, hit, recall): the share of exact results that a search found."""
    marked = found.select(qid, key, F.lit(1).alias("_hit"))
    joined = exact.select(qid, key).join(marked, [qid, key], "left")
    counts = joined.agg(F.count("*").alias("expected"), F.count("_hit").alias("hit"))
    return counts.withColumn("recall", F.col("hit") / F.greatest(F.col("expected"), F.lit(1)))
