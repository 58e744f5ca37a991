"""The scan kernel behind every top-k search: one Arrow batch of vectors against a block of
questions, as a matrix product, keeping only the best k rows per question and task.

Each task emits at most k rows per question however many rows it reads, so neither the
pairs nor any group of equal rows is ever materialized. Order within a question: distance
rounded to 6 digits ascending, then NaN distances, then NULL ones; ties by row key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vecloom.functions.arrow_vectors import matrix_of
from vecloom.functions.vectors import DISTANCE_DIGITS

_TILE = 1 << 22  # score-matrix cells held at once
_SINGLE_LIMIT = 1e30  # squared norms beyond this do not fit single precision


@dataclass
class QuestionBlock:
    """A bounded set of questions; `cells[i]` lists the cells question i probes, if any."""

    keys: pa.Array
    matrix: np.ndarray  # finite questions only
    rows: np.ndarray  # their positions in `keys`
    kinds: np.ndarray  # per key: 0 finite, 1 holds NaN, 2 NULL
    cells: list | None = None

    @classmethod
    def of(cls, keys: pa.Array, vectors: pa.Array, cells: list | None = None) -> QuestionBlock:
        matrix, rows = matrix_of(vectors)
        matrix = matrix.astype(np.float64)
        finite = np.isfinite(matrix).all(axis=1)
        kinds = np.full(len(keys), 2, dtype=np.int8)
        kinds[rows] = np.where(finite, 0, 1)
        return cls(keys, matrix[finite], rows[finite], kinds, cells)

    @property
    def width(self) -> int | None:
        return self.matrix.shape[1] if len(self.matrix) else None


def pair_distances(a: np.ndarray, b: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """Distances of the pairs (a[ia], b[ib]) by differences in double precision, in bounded slices."""
    out = np.empty(len(ia))
    step = max(1, _TILE // max(1, a.shape[1]))
    for at in range(0, len(ia), step):
        delta = a[ia[at : at + step]].astype(np.float64) - b[ib[at : at + step]]
        out[at : at + step] = np.sqrt(np.einsum("ij,ij->i", delta, delta))
    return out


def squared_norms(matrix: np.ndarray) -> np.ndarray:
    """As precise as the matrix, which is why a double-precision `Side` needs a double one."""
    return np.einsum("ij,ij->i", matrix, matrix).astype(np.float64)


class Side:
    """One side of a block of distances, laid out so that one product gives them all.

    With a row (x, |x|^2) on the right and (-2y, 1) on the left, the product is |x-y|^2 - |y|^2.
    """

    def __init__(self, matrix: np.ndarray, norms: np.ndarray, left: bool, single: bool):
        self.matrix, self.norms = matrix, norms
        self.terms = np.empty((len(matrix), matrix.shape[1] + 1), dtype=np.float32 if single else np.float64)
        if left:
            np.multiply(matrix, -2, out=self.terms[:, :-1], casting="same_kind")
            self.terms[:, -1] = 1
        else:
            self.terms[:, :-1] = matrix
            self.terms[:, -1] = norms

    def error(self, other: Side) -> np.ndarray:
        """Bound, for each row here, on the error of its squared distances to rows of `other`.

        A product of n terms is off by at most n roundings; twice that covers the norms too.
        """
        unit = 2.0**-23 if self.terms.dtype == np.float32 else 2.0**-52
        largest = other.norms.max() if len(other.norms) else 0.0
        return (self.terms.shape[1] + 8) * unit * (self.norms + largest)


def fits_single(norms: np.ndarray) -> bool:
    return not len(norms) or norms.max() < _SINGLE_LIMIT


def squared_products(a: np.ndarray, b: np.ndarray, fast: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of all rows of `a` and `b`, and a bound on the error for each row of `a`.

    `fast` works in single precision where the norms allow; callers compute the few
    distances that matter again by differences.
    """
    a2, b2 = squared_norms(a), squared_norms(b)
    single = fast and fits_single(a2) and fits_single(b2)
    if not single:
        a, b = a.astype(np.float64), b.astype(np.float64)
        a2, b2 = squared_norms(a), squared_norms(b)
    left, right = Side(a, a2, True, single), Side(b, b2, False, single)
    squares = left.terms @ right.terms.T
    squares += left.norms.astype(squares.dtype)[:, None]
    return squares, left.error(right)


def first_per_group(groups: np.ndarray, k: int) -> np.ndarray:
    """Mask of the first k members of each run of equal values in the sorted `groups`."""
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.empty(0, int)
    position = np.arange(len(groups)) - np.repeat(starts, np.diff(np.r_[starts, len(groups)]))
    return position < k


def _without_spare_copies(matrix: np.ndarray, k: int) -> np.ndarray:
    """Rows to keep of `matrix`, which is in key order: of equal rows only the first k.

    No further copy can be among the best k of any question, so a vector that fills a third
    of a table costs no more than k rows of a batch.
    """
    keep = np.ones(len(matrix), dtype=bool)
    if len(matrix) <= k:
        return keep
    kind = np.uint32 if matrix.dtype == np.float32 else np.uint64
    bits = np.ascontiguousarray(matrix[:, :16]).view(kind).astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = (bits * (2 * np.arange(1, bits.shape[1] + 1, dtype=np.uint64) ** 5 + 1)).sum(axis=1)
    order = np.argsort(mixed, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(mixed[order]) != 0])
    sizes = np.diff(np.r_[starts, len(order)])
    for start, size in zip(starts[sizes > k], sizes[sizes > k], strict=True):
        group = order[start : start + size]
        if (matrix[group] == matrix[group[0]]).all():
            keep[group[k:]] = False
    return keep


class _Best:
    """The best k (row key, distance) of each question so far, as three parallel arrays."""

    def __init__(self, n_questions: int, k: int, key_type: pa.DataType):
        self.k = k
        self.question = np.empty(0, dtype=np.int64)
        self.distance = np.empty(0)
        self.key = pa.array([], type=key_type)
        self.limit = np.full(n_questions, np.inf)  # distance of the k-th best, once there are k

    def merge(self, question: np.ndarray, distance: np.ndarray, key: pa.Array) -> None:
        question = np.concatenate([self.question, question])
        distance = np.concatenate([self.distance, distance])
        key = pa.concat_arrays([self.key, key])
        by_key = np.empty(len(key), dtype=np.int64)
        by_key[np.asarray(pc.sort_indices(key))] = np.arange(len(key))
        order = np.lexsort((by_key, np.round(distance, DISTANCE_DIGITS), question))
        order = order[first_per_group(question[order], self.k)]
        self.question, self.distance = question[order], distance[order]
        self.key = key.take(pa.array(order))
        full, sizes = np.unique(self.question, return_counts=True)
        full = full[sizes == self.k]
        last = np.searchsorted(self.question, full, side="right") - 1
        self.limit[full] = self.distance[last]


def _scan(questions: Side, chosen: np.ndarray, rows: Side, keys: pa.Array, best: _Best) -> None:
    """Offer `rows`, which are in key order, to the finite questions `chosen`."""
    k, n = best.k, len(rows.matrix)
    step = max(1, _TILE // max(1, n))
    slack = questions.error(rows)
    everyone = len(chosen) == len(questions.matrix)
    for at in range(0, len(chosen), step):
        part = slice(at, at + step) if everyone else chosen[at : at + step]
        norms, error, limit = questions.norms[part], slack[part], best.limit[part]
        products = questions.terms[part] @ rows.terms.T
        if n > k and not np.isfinite(limit).all():
            kth = np.partition(products, k - 1, axis=1)[:, k - 1] + norms
            limit = np.minimum(limit, np.sqrt(np.maximum(kth + error, 0.0)))
        # What rounds to the distance of the k-th row is a tie for the last place.
        bound = (limit + 10.0**-DISTANCE_DIGITS) ** 2 + error - norms
        q, r = np.nonzero(products <= bound.astype(products.dtype)[:, None])
        distance = pair_distances(questions.matrix[part], rows.matrix, q, r)
        # Rows are in key order, so their position breaks ties by key.
        order = np.lexsort((r, np.round(distance, DISTANCE_DIGITS), q))
        order = order[first_per_group(q[order], k)]
        best.merge(chosen[at + q[order]], distance[order], keys.take(pa.array(r[order])))


class _Tail:
    """The first k row keys of a kind; they fill up questions with fewer than k finite rows."""

    def __init__(self, k: int, key_type: pa.DataType):
        self.k, self.keys = k, pa.array([], type=key_type)

    def offer(self, keys: pa.Array) -> None:
        """Keys come in order, so the first k are enough."""
        both = pa.concat_arrays([self.keys, keys[: self.k]])
        self.keys = both.take(pc.sort_indices(both)[: self.k])


def _emit(block: QuestionBlock, best: _Best, tails: dict, k: int, schema: pa.Schema) -> pa.RecordBatch:
    """Best rows of each question, filled up with NaN and NULL distances where fewer than k."""
    question = [block.rows[best.question]]
    keys, distances = [best.key], [pa.array(best.distance)]
    counts = np.zeros(len(block.keys), dtype=np.int64)
    np.add.at(counts, question[0], 1)
    # Which kinds of question have anything to be filled up with: finite, holding NaN, NULL.
    stock = {kind: len(tail.keys) > 0 for kind, tail in tails.items()}
    fillable = np.array([stock["nan"] or stock["null"], stock["present"] or stock["null"], stock["any"]])
    for index in np.flatnonzero((counts < k) & fillable[block.kinds]):
        kind, room = block.kinds[index], k - counts[index]
        if kind == 2:
            fills = [(tails["any"].keys, None)]
        elif kind == 1:
            fills = [(tails["present"].keys, float("nan")), (tails["null"].keys, None)]
        else:
            fills = [(tails["nan"].keys, float("nan")), (tails["null"].keys, None)]
        for fill, distance in fills:
            fill = fill[:room]
            room -= len(fill)
            question.append(np.full(len(fill), index))
            keys.append(fill)
            distances.append(pa.array([distance] * len(fill), type=pa.float64()))
    qid = block.keys.take(pa.array(np.concatenate(question).astype(np.int64)))
    return pa.RecordBatch.from_arrays([qid, pa.concat_arrays(keys), pa.concat_arrays(distances)], schema=schema)


def best_rows(
    batches: Iterator[pa.RecordBatch], block: QuestionBlock, k: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Scan (key, vector[, cell]) batches; yield (question, key, distance), best k per question.

    With a cell column each row is offered only to the questions that probe its cell.
    """
    key_type = schema.field(1).type
    best = _Best(len(block.matrix), k, key_type)
    tails = {kind: _Tail(k, key_type) for kind in ("any", "present", "nan", "null")}
    everyone = np.arange(len(block.matrix))
    question_norms = squared_norms(block.matrix)
    sides: dict[bool, Side] = {}
    probing: dict = {}
    if block.cells is not None:
        probes = [block.cells[row] or () for row in block.rows]
        asker = np.repeat(np.arange(len(probes)), [len(cells) for cells in probes])
        probed = np.fromiter((cell for cells in probes for cell in cells), dtype=np.int64, count=len(asker))
        order = np.argsort(probed, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(probed[order]) != 0]) if len(order) else []
        probing = {int(probed[order[at]]): part for at, part in zip(starts, np.split(asker[order], starts[1:]), strict=False)}
    for batch in batches:
        if not _in_order(batch.column(0)):
            batch = batch.take(pc.sort_indices(batch.column(0)))
        keys, vectors = batch.column(0).cast(key_type), batch.column(1)
        matrix, rows = matrix_of(vectors, block.width)
        norms = squared_norms(matrix)
        if matrix.dtype == np.float32 and not (np.isfinite(norms).all() and fits_single(norms)):
            # NaN, or norms too large for single precision: tell them apart in double precision.
            matrix = matrix.astype(np.float64)
            norms = squared_norms(matrix)
        finite = np.isfinite(norms)
        single = fits_single(question_norms) and fits_single(norms[finite])
        if not single and matrix.dtype == np.float32:
            matrix = matrix.astype(np.float64)
            norms = squared_norms(matrix)
        if block.cells is None:
            tails["any"].offer(keys)
            if len(rows) < len(keys) or not finite.all() or len(block.rows) < len(block.keys):
                tails["present"].offer(keys.take(pa.array(rows)))
                tails["nan"].offer(keys.take(pa.array(rows[~finite])))
                tails["null"].offer(keys.filter(pc.is_null(vectors)))
        if not finite.all():
            matrix, norms, rows = matrix[finite], norms[finite], rows[finite]
        if not len(matrix) or not len(block.matrix):
            continue
        kept = _without_spare_copies(matrix, k)
        if not kept.all():
            matrix, norms, rows = matrix[kept], norms[kept], rows[kept]
        if single not in sides:
            sides[single] = Side(block.matrix, question_norms, True, single)
        keys = keys.take(pa.array(rows))
        if block.cells is None:
            _scan(sides[single], everyone, Side(matrix, norms, False, single), keys, best)
            continue
        cells = np.asarray(batch.column(2))[rows]
        for cell in np.unique(cells):
            if cell in probing:
                own = np.flatnonzero(cells == cell)
                part = Side(matrix[own], norms[own], False, single)
                _scan(sides[single], probing[cell], part, keys.take(pa.array(own)), best)
    yield _emit(block, best, tails, k, schema)


def _in_order(keys: pa.Array) -> bool:
    return len(keys) < 2 or bool(pc.all(pc.less_equal(keys[:-1], keys[1:]), skip_nulls=False).as_py())
