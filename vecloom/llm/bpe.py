"""Operator 4: exact BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is exactly one token that ends its encoding. It is found among
the tokens that match as a suffix of the prefix (one step of a suffix-matching automaton gives them
all, longest first) as the one that is compatible with the last token of what stands before it. Whether
two tokens stay apart side by side is decided by taking apart the merges that made them, newest
first. Back-pointers from the whole word give the ids; no merge loop runs over texts.

No token reaches over white space, so each Python worker keeps the ids of the pieces between white
space it has met, and of their words, up to about `KEPT_BYTES`. It is a map over Arrow batches
without a shuffle; the tokenizer file travels as one broadcast of its own size (about 2 MB), which
does not grow with the data. Decoding needs the names of the ids only, and builds no encoder.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from vecloom.llm.kept import kept
from vecloom.session import ship_package

KEPT_BYTES = 128 << 20  # of pieces and words with their ids, as Python objects
KEPT_PAIRS = 200_000  # about 100 bytes each
BATCH_CHARS = 1 << 18  # working lists take about 30 times as much
# What common scripts don't use; texts with such letters are looked at again, letter by letter.
_UNCOMMON = regex.compile(r"[^\u0000-\u0377\u0384-\u038A\u038E-\u03A1\u03A3-\u052F\u2010-\u2064]")

_SPACE = regex.compile(r"\p{White_Space}+")
_ODD = regex.compile("[\x1c-\x1f]")  # str.split takes these for white space, the file does not


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself where printable."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


class Merges:
    """Tokens as strings of symbols, and which pairs of tokens stay apart.

    A symbol is a byte, or 256 + byte at the end of a word. `made[(a, b)]` is the token that
    merging a and b gives; ids rise in the order of merges.
    """

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[tuple[int, int], int] = {}
        order = []
        for pair in merges:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            whole = vocab[left + right]
            self.parts[whole] = pair = (vocab[left], vocab[right])
            self.made[pair] = whole
            order.append(whole)
        if any(x >= y for x, y in zip(order, order[1:], strict=False)):
            raise ValueError("token ids must rise in the order of merges")
        self.symbols: dict[int, str] = {}
        for text, i in vocab.items():
            ends = bool(suffix) and text.endswith(suffix)
            core = text[: -len(suffix)] if ends else text
            if not core or any(c not in byte_of for c in core):
                continue
            raw = [byte_of[c] for c in core]
            raw[-1] += 256 * ends
            self.symbols[i] = "".join(map(chr, raw))
        self.known: dict[int, bool] = {}  # by a << 32 | b

    def apart(self, a: int, b: int) -> bool:
        """Whether a and b, each an encoding of its own text, stay a and b side by side."""
        pair = a << 32 | b
        found = self.known.get(pair)
        if found is None:
            if len(self.known) >= KEPT_PAIRS:
                self.known.clear()
            found = self.known[pair] = self._apart(a, b)
        return found

    def _apart(self, a: int, b: int) -> bool:
        """Goes back in time: the newer neighbour of the border is undone, until one merge
        would have joined the two sides before that, or nothing is left to undo."""
        parts, made = self.parts, self.made
        newest = 1 << 60  # merges from this one on had not happened yet
        while True:
            joined = made.get((a, b))
            if joined is not None and joined < newest:
                return False
            undo_left = a in parts and (a > b or b not in parts)
            if undo_left:
                newest = a
                a = parts[a][1]
            elif b in parts:
                # Of equal tokens the left one is made first, so this one's merge may come first.
                newest = b + 1
                b = parts[b][0]
            else:
                return True


class Suffixes:
    """Automaton whose state after some symbols has the tokens that end there, longest first."""

    def __init__(self, tokens: dict[int, str]):
        self.steps: list[dict[str, int]] = [{}]
        self.back = [0]
        self.ends: list[tuple] = [()]
        own: dict[int, tuple[int, int]] = {}
        for token, symbols in tokens.items():
            state = 0
            for c in symbols:
                after = self.steps[state].get(c)
                if after is None:
                    after = self.steps[state][c] = len(self.steps)
                    self.steps.append({})
                    self.back.append(0)
                    self.ends.append(())
                state = after
            own[state] = (token, len(symbols))
        level = list(self.steps[0].values())
        for state in level:
            self.ends[state] = (own[state],) if state in own else ()
        while level:
            below = []
            for state in level:
                for c, after in self.steps[state].items():
                    self.back[after] = back = self._fall(self.back[state], c)
                    self.ends[after] = ((own[after],) if after in own else ()) + self.ends[back]
                    below.append(after)
            level = below

    def _fall(self, state: int, c: str) -> int:
        while c not in self.steps[state] and state:
            state = self.back[state]
        return self.steps[state].get(c, 0)

    def step(self, state: int, c: str) -> int:
        after = self.steps[state].get(c)
        return self._fall(state, c) if after is None else after


class Encoder:
    """Ids of texts by one tokenizer file."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.suffixed = bool(model.get("end_of_word_suffix"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        # `\s` of the file's regex language is the Unicode property.
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        # Without its vocabulary, of which the library would make a second copy.
        plain = spec | {"added_tokens": [], "post_processor": None, "model": {"type": "BPE", "vocab": {}, "merges": []}}
        file = tokenizers.Tokenizer.from_str(json.dumps(plain))
        self.normalizer, self.pre_tokenizer = file.normalizer, file.pre_tokenizer
        self.suffixes = Suffixes({i: s for i, s in self.merges.symbols.items() if self._own(i, s)})
        self.reset()

    def _own(self, token: int, symbols: str) -> bool:
        """Whether a token is the encoding of its own text; others never come up."""
        if len(symbols) == 1:
            return True
        pair = self.merges.parts.get(token)
        return pair is not None and self._reached(pair)

    def _reached(self, pair: tuple[int, int]) -> bool:
        # A pair made of tokens that stay apart but for its own merge.
        made = self.merges.made.pop(pair)
        apart = self.merges._apart(*pair)
        self.merges.made[pair] = made
        return apart

    def reset(self) -> None:
        self.known_words: dict[str, list[int]] = {}
        self.index: dict[str, int] = {}
        self.kept = 0
        self.flat, self.begin, self.length = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def solve(self, words: list[str]) -> None:
        """Adds words to the known ones.

        The last token of a prefix depends on the prefix alone, so in sorted order each word goes
        on from what it shares with the one before.
        """
        steps, ends, fall = self.suffixes.steps, self.suffixes.ends, self.suffixes._fall
        apart, known = self.merges.apart, self.merges.known
        # Of each prefix: its last token, where that begins, and the automaton's state.
        last, begins, states, before = [-1], [0], [0], ""
        suffixed = self.suffixed
        for symbols, word in sorted((w.encode("utf-8", "surrogatepass").decode("latin-1"), w) for w in words):
            n = len(symbols)
            shared, most = 0, min(len(before), n) - suffixed
            while shared < most and symbols[shared] == before[shared]:
                shared += 1
            before = symbols
            del last[shared + 1 :], begins[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            for end in range(shared + 1, n + 1):
                c = symbols[end - 1]
                if suffixed and end == n:
                    c = chr(256 + ord(c))
                state = steps[state][c] if c in steps[state] else fall(state, c)
                for token, size in ends[state]:
                    left = last[end - size]
                    if left < 0 or (known[pair] if (pair := left << 32 | token) in known else apart(left, token)):
                        break
                last.append(token)
                begins.append(end - size)
                states.append(state)
            ids, at = [], n
            while at:
                ids.append(last[at])
                at = begins[at]
            ids.reverse()
            self.known_words[word] = ids
            self.kept += 200 + 4 * len(word) + 8 * len(ids)
            if suffixed:  # the prefix that ends the word is not the prefix of a longer one
                last.pop(), begins.pop(), states.pop()
                before = symbols[:-1] + chr(512)

    def split(self, piece: str) -> list[str]:
        """The words of a text that is no special token."""
        if not piece.isascii():
            if _UNCOMMON.search(piece) and any(unicodedata.category(c) == "Cn" for c in set(piece)):
                # Letters newer than this Python's tables: word borders are left to the file's own.
                plain = self.normalizer.normalize_str(piece)
                return [plain[b:e] for _, (b, e) in self.pre_tokenizer.pre_tokenize_str(plain)]
            # Lower case is taken letter by letter, so a final sigma is like any other.
            piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
        return self.words.findall(piece.lower())

    def solve_pieces(self, pieces: set[str]) -> list[list[int]]:
        """The ids of pieces that stand between white space."""
        split = []
        for piece in pieces:
            if "<|" in piece:
                parts = self.cut.split(piece)
                words = [w for k, x in enumerate(parts) for w in ([self.special[x]] if k % 2 else self.split(x))]
            else:
                words = self.split(piece)
            split.append(words)
        known = self.known_words
        self.solve({w for words in split for w in words if w not in known and not isinstance(w, int)})
        return [list(chain.from_iterable([w] if isinstance(w, int) else known[w] for w in words)) for words in split]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of some texts."""
        if self.kept > KEPT_BYTES:
            self.reset()
        pieces = [(_SPACE.split(t) if _ODD.search(t) else t.split()) if t else [] for t in texts]
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        new = set().union(*pieces).difference(self.index)
        if new:
            solved = self.solve_pieces(new)
            sizes = np.fromiter(map(len, solved), np.int64, len(solved))
            self.index.update(zip(new, range(len(self.length), len(self.length) + len(new)), strict=True))
            self.kept += 220 * len(new) + 4 * (sum(map(len, new)) + int(sizes.sum()))
            self.begin = np.r_[self.begin, len(self.flat) + np.cumsum(sizes) - sizes]
            self.flat = np.r_[self.flat, np.fromiter(chain.from_iterable(solved), np.int32, sizes.sum())]
            self.length = np.r_[self.length, sizes.astype(np.int32)]
        index = np.fromiter(map(self.index.__getitem__, chain.from_iterable(pieces)), np.int64, counts.sum())
        lengths = self.length[index].astype(np.int64)
        ends = np.r_[0, np.cumsum(lengths)]
        ids = self.flat[np.repeat(self.begin[index] - ends[:-1], lengths) + np.arange(ends[-1])]
        return ends[np.r_[0, np.cumsum(counts)]], ids


def _encoder(source: str) -> Encoder:
    """One per Python worker and tokenizer file."""
    return kept(("encoder", source), lambda: Encoder(source))


_names: dict[str, np.ndarray] = {}


def _id_names(source: str) -> np.ndarray:
    """The token of each id (None: no such id), one table per Python worker and tokenizer file."""
    if source not in _names:
        spec = json.loads(source)
        if spec.get("decoder") is not None:
            raise ValueError("only files without a decoder are supported")
        token = {i: t for t, i in spec["model"]["vocab"].items()}
        token |= {t["id"]: t["content"] for t in spec["added_tokens"]}
        table = np.empty(max(token, default=-1) + 1, object)
        for i, name in token.items():
            table[i] = name
        _names.clear()
        _names[source] = table
    return _names[source]


def _pieces(column: pa.Array) -> Iterator[list]:
    """Texts of a column in runs of about BATCH_CHARS characters."""
    run, size = [], 0
    for scalar in column:
        text = scalar.as_py()
        run.append(text)
        size += len(text or "")
        if size >= BATCH_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _with(df: DataFrame, name: str, kind) -> StructType:
    if name in df.columns:
        raise ValueError(f"column {name} exists already; choose another output name")
    return StructType([*df.schema.fields, StructField(name, kind)])


def _encoding(source, text: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(source.value)
        for batch in batches:
            at = 0
            for texts in _pieces(batch[text]):
                offsets, ids = encoder.encode(texts)
                part = batch.slice(at, len(texts))
                at += len(texts)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, out])

    return run


def _decoding(source, ids: str, out: str, drop: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _id_names(source.value)
        size = len(table)
        for batch in batches:
            lists = batch[ids]
            flat = np.asarray(lists.values.slice(0).to_numpy(zero_copy_only=False))
            offsets = lists.offsets.to_numpy()
            texts = []
            for k, (b, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                own = flat[b:e] if lists[k].is_valid else flat[:0]
                own = own[(own >= 0) & (own < size)]
                texts.append(" ".join(t for t in table[own].tolist() if t is not None))
            kept = [c for c in batch.schema.names if c != drop]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(texts, pa.string())], names=[*kept, out])

    return run


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """`docs` with `out array<int>`: the token ids of each whole text, without added tokens.

    `path` is a tokenizer file of the word-end or plain byte-level BPE kind, read on the driver.
    Its truncation and padding are not used. NULL and empty texts give an empty array. All
    columns stay; if `out` is one of them, that is an error. Rows keep their order and number.
    """
    spark = docs.sparkSession
    ship_package(spark)
    source = spark.sparkContext.broadcast(_read(path))
    return docs.mapInArrow(_encoding(source, text, out), _with(docs, out, ArrayType(IntegerType(), False)))


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded", drop: bool = False) -> DataFrame:
    """`rows` with `out string`: the tokens of `ids` by the tokenizer file.

    A file without a decoder joins them by one space. NULL ids read as none; an id that the
    file doesn't have is left out. `drop` leaves the ids out of the result.
    """
    spark = rows.sparkSession
    ship_package(spark)
    source = spark.sparkContext.broadcast(_read(path))
    schema = _with(rows.drop(ids) if drop else rows, out, StringType())
    return rows.mapInArrow(_decoding(source, ids, out, ids if drop else None), schema)


def encode_and_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` without `text`, with `ids` and `decoded`: `encode`, then `decode`, in one Python worker a task."""
    spark = docs.sparkSession
    ship_package(spark)
    source = spark.sparkContext.broadcast(_read(path))
    there = _encoding(source, text, "ids")
    back = _decoding(source, "ids", "decoded", text)
    with_ids = _with(docs, "ids", ArrayType(IntegerType(), False))
    kept = [f for f in with_ids.fields if f.name != text]
    if "decoded" in docs.columns:
        raise ValueError("column decoded exists already")
    return docs.mapInArrow(
        lambda batches: back(there(batches)), StructType([*kept, StructField("decoded", StringType())])
    )


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of tokens, and digests of the ids and of the decoded text."""
    return encode_and_decode(docs.select("doc_id", "text"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
