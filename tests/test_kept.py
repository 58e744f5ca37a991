"""A worker that goes on to another operator drops the tables of the one before."""

import gc
import weakref

import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers

from vecloom.llm import bpe
from vecloom.llm.kept import kept
from vecloom.llm.ngram_join import _emit, _sets

TEXTS = pa.array(["one two three four five six", "Σ eins ʼn zwei <|endoftext|> drei", None, "", "\x1c a ΑΣ"])
EMPTY = pa.table({k: pa.array([], t) for k, t in (("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()))})


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("word_bpe_49k.json")


def emit():
    _emit(5, 3)([pa.scalar(0)], pa.table({"text": TEXTS}))


def sets():
    columns = {"doc_id": pa.array(range(5), pa.int64()), "text_hash": pa.array(range(5), pa.int64()), "text": TEXTS}
    assert _sets(5, 80, 3, pa.int64())(None, pa.table(columns), EMPTY).num_rows == 5


@pytest.mark.parametrize("other", [emit, sets])
def test_encoder_is_kept_until_another_operator_comes(path, other):
    source = bpe._read(path)
    first = bpe._encoder(source)
    assert bpe._encoder(source) is first
    gone = weakref.ref(first)
    del first
    other()
    gc.collect()
    assert gone() is None


def test_one_operator_has_tables_at_a_time():
    made = []
    for key in ("a", "a", "b", "a"):
        kept((key,), lambda k=key: made.append(k) or k)
    assert made == ["a", "b", "a"]


def test_ids_are_those_of_the_library_with_its_vocabulary_left_out(path):
    texts = [t or "" for t in TEXTS.to_pylist()] + ["\U0001fae9 Ünï ẞ é \U0001f6dc࢏", "x" * 300]
    file = tokenizers.Tokenizer.from_file(path)
    file.no_truncation()
    offsets, ids = bpe._encoder(bpe._read(path)).encode(texts)
    assert [ids[b:e].tolist() for b, e in zip(offsets[:-1], offsets[1:], strict=True)] == [
        file.encode(t, add_special_tokens=False).ids for t in texts
    ]
