"""The scan kernel alone, on small whole-number vectors where ties are everywhere."""

import math

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from vecloom.operators.scoring import QuestionBlock, best_rows, squared_products

SCHEMA = pa.schema([("qid", pa.int64()), ("key", pa.int64()), ("distance", pa.float64())])
NUMBER = st.integers(-1, 1).map(float)
VECTOR = st.one_of(
    st.none(), st.lists(NUMBER, min_size=3, max_size=3), st.just([math.nan, 0.0, 1.0]), st.just([1.0, 1.0, 0.0])
)
LIST32, LIST64 = pa.list_(pa.float32()), pa.list_(pa.float64())


def rank(question, key, vector):
    if question is None or vector is None:
        return (2, 0.0, key)
    distance = float(np.linalg.norm(np.array(vector) - np.array(question)))
    return (1, 0.0, key) if math.isnan(distance) else (0, round(distance, 6), key)


def found(batches, block, k):
    """Ranks per question, as the merge of the tasks' results sees them."""
    out = {}
    for batch in best_rows(iter(batches), block, k, SCHEMA):
        for row in batch.to_pylist():
            d = row["distance"]
            place = (2, 0.0) if d is None else (1, 0.0) if math.isnan(d) else (0, round(d, 6))
            out.setdefault(row["qid"], []).append((*place, row["key"]))
    return {qid: sorted(ranks) for qid, ranks in out.items()}


@settings(max_examples=150, deadline=None)
@given(
    st.lists(VECTOR, min_size=1, max_size=60),
    st.lists(VECTOR, min_size=1, max_size=6),
    st.integers(1, 8),
    st.integers(1, 20),
    st.sampled_from([LIST32, LIST64]),
    st.randoms(),
)
def test_best_rows_equal_brute_force(corpus, questions, k, batch, kind, random):
    keys = list(range(len(corpus)))
    random.shuffle(keys)
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array(keys[at : at + batch]), pa.array(corpus[at : at + batch], kind)], names=["key", "vector"]
        )
        for at in range(0, len(corpus), batch)
    ]
    block = QuestionBlock.of(pa.array(range(len(questions))), pa.array(questions, LIST64))
    expected = {
        q: sorted(rank(question, key, vector) for key, vector in zip(keys, corpus))[:k]
        for q, question in enumerate(questions)
    }
    assert found(batches, block, k) == expected


@settings(max_examples=50, deadline=None)
@given(st.floats(1e-3, 1e18), st.integers(1, 40), st.integers(0, 1000))
def test_error_bound_holds(scale, dim, seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.standard_normal((20, dim)) * scale for _ in range(2))
    a, b = a.astype(np.float32), (a[:20] + b * 1e-4).astype(np.float32)
    squares, error = squared_products(a, b)
    exact = ((a.astype(np.float64)[:, None] - b.astype(np.float64)[None]) ** 2).sum(axis=2)
    assert (np.abs(squares - exact) <= error[:, None]).all()


def test_vectors_too_large_for_single_precision():
    vectors = [[1e25, 0.0, 0.0], [1e25, 1e19, 0.0], [0.0, 0.0, 1.0], [3e38, 3e38, 3e38], [math.nan, 0.0, 0.0], None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(vectors, LIST32)], names=["key", "vector"])
    questions = [[0.0, 0.0, 0.0], [1e25, 1e19, 0.0]]
    block = QuestionBlock.of(pa.array(range(2)), pa.array(questions, LIST32))
    rounded = [None if v is None else np.array(v, dtype=np.float32).astype(float).tolist() for v in vectors]
    asked = np.array(questions, dtype=np.float32).astype(float).tolist()
    expected = {q: sorted(rank(asked[q], key, v) for key, v in enumerate(rounded)) for q in range(2)}
    got = found([batch], block, 6)
    assert {q: [r[0] for r in ranks] for q, ranks in got.items()} == {q: [r[0] for r in e] for q, e in expected.items()}
    assert {q: [r[2] for r in ranks] for q, ranks in got.items()} == {q: [r[2] for r in e] for q, e in expected.items()}
