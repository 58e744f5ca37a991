"""Operator 7: removal of passages that recur anywhere in the corpus, by phrase automata.

A window is `window` consecutive words of a text. Words covered by a window whose words also
start elsewhere, in the same text or another, are removed.

1. Recurring phrases. Each window names one phrase of `PHRASE` words in it, the one with the
   least hash, so equal windows name the same one, and neighbours mostly share theirs. Named
   phrases are counted over the corpus (`blocks`): one for about fifteen words.
2. Automata. Each block compiles the recurring phrases found in its texts into an
   Aho-Corasick automaton and streams all its texts through it, which locates every occurrence.
3. Confirmation. Windows that name a located phrase are counted over the corpus as whole
   windows (64-bit hashes); only those that occur twice or more count as recurring.
4. The words that such windows cover are removed, text by text.

Automata, counts and texts are bounded by the block (about 12 MB of text, or one longer text),
whatever a phrase's or a copy's frequency; no shuffle carries more than the texts themselves.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vecloom.llm import blocks
from vecloom.llm.wordhash import U64, ngrams, slices, whole
from vecloom.session import ship_package

PHRASE = 8
_TOP = U64(0xFFFFFFFFFFFFFFFF)


def _sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    """`pick` (minimum or maximum) of each n consecutive values."""
    done, have = values, 1
    while have < n:
        step = min(have, n - have)
        done = pick(done[: len(done) - step], done[step:])
        have += step
    return done


class _Scan:
    """Phrases and windows of the texts of a slice."""

    def __init__(self, words, window: int):
        self.words, self.hashes = words, words.hashes()
        self.inside = whole(words, window)
        self.phrases = ngrams(self.hashes, PHRASE)
        # The phrase that each window names; no window reaches into another text.
        self.named = _sliding(self.phrases, window - PHRASE + 1, np.minimum) if self.inside.any() else None

    def selected(self, window: int) -> np.ndarray:
        """Which places hold a phrase that some window over them names."""
        span = window - PHRASE
        named = np.where(self.inside, self.named, U64(0))
        padded = np.r_[np.zeros(span, U64), named, np.zeros(span, U64)]
        return _sliding(padded, span + 1, np.maximum)[: len(self.phrases)] == self.phrases

    def letters(self) -> np.ndarray:
        """Each word as three letters of six bits, each from an alphabet of its own."""
        h = self.hashes
        out = np.empty((len(h), 3), np.uint8)
        for i in range(3):
            out[:, i] = ((h >> U64(6 * i)) & U64(63)).astype(np.uint8) + np.uint8(64 * i)
        return out


def _phrases(window: int, bits: int):
    def run(key, table):
        found = []
        for chunk in table["text"].chunks:
            for _, _, words in slices(chunk, False):
                scan = _Scan(words, window)
                if scan.named is not None:
                    found.append(scan.phrases[scan.selected(window)])
        every = np.concatenate(found) if found else np.zeros(0, U64)
        return blocks.packed(key[0].as_py(), every, bits, 32)

    return run


def _automaton(scans, known: blocks.Recurring, window: int):
    patterns = set()
    for scan in scans:
        places = np.flatnonzero(scan.selected(window))
        places = places[known.counts(scan.phrases[places]) > 1]
        letters = scan.letters()
        patterns.update(letters[p : p + PHRASE].tobytes() for p in places)
    machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for p in patterns:
        machine.add_word(p.decode("latin-1"))
    machine.make_automaton()
    return machine


def _windows(window: int, bits: int):
    def run(key, table, known):
        recurring = blocks.Recurring(known, bits, 32)
        scans = lambda: (
            s
            for chunk in table["text"].chunks
            for _, _, words in slices(chunk, False)
            if (s := _Scan(words, window)).named is not None
        )
        machine, found = _automaton(scans(), recurring, window), []
        for scan in scans() if len(machine) else ():
            located = np.zeros(len(scan.phrases), bool)
            text = scan.letters().tobytes().decode("latin-1")
            ends = np.fromiter((end for end, _ in machine.iter(text)), np.int64)
            located[(ends + 1) // 3 - PHRASE] = True
            least = _sliding(np.where(located, scan.phrases, _TOP), window - PHRASE + 1, np.minimum)
            hit = scan.inside & (least == scan.named)
            found.append(ngrams(scan.hashes, window)[hit])
        every = np.concatenate(found) if found else np.zeros(0, U64)
        return blocks.packed(key[0].as_py(), every, bits, 64 - bits)

    return run


def _covered(words, hit: np.ndarray, window: int) -> np.ndarray:
    edge = np.zeros(len(words.row) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge)[:-1] > 0


def kept_texts(words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    data = words.data.copy()
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, words.start[keep], 1)
    np.add.at(inside, words.end[keep], -1)
    mask = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    kept = np.flatnonzero(keep)
    later = kept[1:][words.row[kept[1:]] == words.row[kept[:-1]]]
    # A word that is not the first of its text has a separator before it.
    data[words.start[later] - 1] = 0x20
    mask[words.start[later] - 1] = True
    sizes = np.r_[0, np.cumsum(mask)][words.offsets]
    buffers = [None, pa.py_buffer(sizes.astype(np.int64).tobytes()), pa.py_buffer(data[mask].tobytes())]
    return pa.LargeStringArray.from_buffers(len(sizes) - 1, buffers[1], buffers[2]).cast(pa.string())


def _spans(words, gone: np.ndarray) -> list[list[dict]]:
    """Removed runs of words of each text, as [first, last + 1)."""
    edge = np.r_[True, words.row[1:] != words.row[:-1]] if len(gone) else np.zeros(0, bool)
    begin = np.flatnonzero(gone & (edge | ~np.r_[False, gone[:-1]]))
    stop = np.flatnonzero(gone & (np.r_[edge[1:], True] | ~np.r_[gone[1:], False])) + 1
    out: list[list[dict]] = [[] for _ in words.count]
    for b, e in zip(begin.tolist(), stop.tolist(), strict=True):
        row = int(words.row[b])
        out[row].append({"first": b - int(words.first[row]), "end": e - int(words.first[row])})
    return out


_SPAN = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))


def _removal(window: int, bits: int, id_type: pa.DataType):
    def run(_, table, known):
        recurring = blocks.Recurring(known, bits, 64 - bits)
        n_words, n_removed, kept, spans = [], [], [], []
        for chunk in table["text"].chunks:
            for _, _, words in slices(chunk, False):
                gone = np.zeros(len(words.row), bool)
                inside = whole(words, window)
                if len(recurring.keys) and inside.any():
                    counts = recurring.counts(ngrams(words.hashes(), window))
                    gone = _covered(words, inside & (counts > 1), window)
                n_words.append(words.count)
                n_removed.append(np.bincount(words.row[gone], minlength=len(words.count)))
                kept.append(kept_texts(words, ~gone))
                spans.append(pa.array(_spans(words, gone), _SPAN))
        join = lambda parts, kind: pa.chunked_array(parts, kind)
        return pa.table(
            {
                "doc_id": table["doc_id"].cast(id_type),
                "n_words": pa.array(np.concatenate(n_words) if n_words else [], pa.int64()),
                "n_removed": pa.array(np.concatenate(n_removed) if n_removed else [], pa.int64()),
                "kept": join(kept, pa.string()),
                "removed": join(spans, _SPAN),
            }
        )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, removed) of every row of `docs`.

    `kept` has the words that stay, joined by one space; `removed` the runs of words taken out,
    as word numbers [first, end). Words are what stands between white space, unchanged. Windows
    are judged on the input. Repeated rows are texts of their own, so copies of `window` words
    or more lose everything. NULL and wordless texts give 0 words and an empty `kept`; other
    columns are ignored; an empty table gives no rows.
    """
    if window <= PHRASE:
        raise ValueError(f"window must be over {PHRASE} words")
    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    total = blocks.text_bytes(rows, "text")
    bits = blocks.bucket_bits(total)
    dealt = blocks.blocked(rows, total, ["doc_id", "text"])
    texts = dealt.groupBy("block")
    sent = texts.applyInArrow(_phrases(window, bits), blocks.COUNTS_SCHEMA)
    named = blocks.recurring(sent, 32)
    sent = texts.cogroup(blocks.beside(named, total)).applyInArrow(_windows(window, bits), blocks.COUNTS_SCHEMA)
    known = blocks.recurring(sent, 64 - bits)
    schema = (
        f"doc_id {kind.simpleString()}, n_words long, n_removed long, kept string, "
        "removed array<struct<first:int,end:int>>"
    )
    out = texts.cogroup(blocks.beside(known, total)).applyInArrow(_removal(window, bits, to_arrow_type(kind)), schema)
    return out.withColumnRenamed("doc_id", id_col)
