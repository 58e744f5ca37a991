"""Operator 9: token ids of documents packed into rows of fixed length for training.

Documents are encoded by a byte-level BPE file, dealt out into groups by hash, and packed group
by group with best-fit-decreasing: segments go longest first to the row with the least room that
still holds them, found by a segment tree over the amounts of room. Longer documents are
split into full rows and a rest; no token is lost or doubled. A row holds its ids, filled up with
`pad`, the cumulative segment lengths, positions that begin at 0 in each segment, and each
segment's document and first token.

Groups hold about GROUP_TOKENS tokens, so memory is bounded and only the last rows of a group
can be part empty. Rows are dealt out by their places in the stored table, so equal rows part
like any others; they are packed as often as they come. Ids and positions stay little-endian int32
in one binary value a row from the encoder to the files.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vecloom.session import ship_package

GROUP_TOKENS = 1 << 21
CAPACITY = 2048
# Fixed value: the split pattern of the vocabulary file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class RoomTree:
    """Rows by the room left in them: the least room that is enough, in log(capacity) steps."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        at = self.size + room
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) with the least room of at least `least`, taken out."""
        count, at = self.count, self.size + least
        while not count[at]:
            while at & 1:  # nothing here: up while this is a right child
                at >>= 1
                if at <= 1:
                    return None
            at += 1
        while at < self.size:
            at *= 2
            if not count[at]:
                at += 1
        room = at - self.size
        row = self.rows[room].pop()
        self._change(room, -1)
        return room, row


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Segments of each row, by number, packed longest first; ties by number."""
    tree, rows = RoomTree(capacity), []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = tree.take(lengths[k])
        if found is None:
            found = (capacity, len(rows))
            rows.append([])
        room, row = found
        rows[row].append(k)
        tree.add(room - lengths[k], row)
    return rows


def _pack(capacity: int, pad: int, id_type: pa.DataType):
    def run(key, table):
        ids = [np.frombuffer(x.as_buffer(), "<i4") for x in table["ids"]]
        owners, firsts, lengths = [], [], []
        for d, own in enumerate(ids):
            for first in range(0, len(own), capacity):
                owners.append(d)
                firsts.append(first)
                lengths.append(min(capacity, len(own) - first))
        rows = best_fit(lengths, capacity)
        matrix = np.full((len(rows), capacity), pad, np.int32)
        places = np.zeros((len(rows), capacity), np.int32)
        sums, docs, begins = [], [], []
        for r, row in enumerate(rows):
            at = [0]
            for k in row:
                n = lengths[k]
                matrix[r, at[-1] : at[-1] + n] = ids[owners[k]][firsts[k] : firsts[k] + n]
                places[r, at[-1] : at[-1] + n] = np.arange(n)
                at.append(at[-1] + n)
            sums.append(at)
            docs.append([owners[k] for k in row])
            begins.append([firsts[k] for k in row])
        ends = pa.py_buffer((np.arange(len(rows) + 1, dtype=np.int32) * 4 * capacity).tobytes())
        flat = lambda m: pa.Array.from_buffers(
            pa.binary(), len(rows), [None, ends, pa.py_buffer(m.astype("<i4", copy=False))]
        )
        known = table["doc_id"].combine_chunks().cast(id_type)
        counts = np.r_[0, np.cumsum([len(d) for d in docs])].astype(np.int32)
        owners = known.take(pa.array([d for row in docs for d in row], pa.int64()))
        return pa.table(
            {
                "grp": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                "pack": pa.array(range(len(rows)), pa.int32()),
                "n_tokens": pa.array([s[-1] for s in sums], pa.int32()),
                "ids": flat(matrix),
                "positions": flat(places),
                "cu_seqlens": pa.array(sums, pa.list_(pa.int32())),
                "doc_ids": pa.ListArray.from_arrays(pa.array(counts), owners),
                "first_tokens": pa.array(begins, pa.list_(pa.int32())),
            }
        )

    return run


_encodings: dict[bytes, tiktoken.Encoding] = {}


def _encoding(ranks_file: bytes) -> tiktoken.Encoding:
    """One per Python worker and vocabulary file."""
    if ranks_file not in _encodings:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        _encodings.clear()
        _encodings[ranks_file] = tiktoken.Encoding(
            "packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[ranks_file]


def token_ids(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(doc_id, h, ids) by a tiktoken vocabulary file; NULL and empty texts have no ids.

    `ids` are little-endian 32-bit numbers in one binary value, which Spark moves as a whole.
    """
    spark = docs.sparkSession
    with open(path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, h long, ids binary"

    def numbers(made: tiktoken.Encoding, text: str) -> bytes:
        return made.encode_to_numpy(text, disallowed_special=()).astype("<i4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _encoding(shared.value)
        for batch in batches:
            found = pa.array([numbers(made, t.as_py() or "") for t in batch["text"]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["h"], found], names=["doc_id", "h", "ids"])

    key = F.xxhash64(F.monotonically_increasing_id())
    return docs.select("doc_id", key.alias("h"), F.col(text).alias("text")).mapInArrow(run, schema)


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, pad: int = 0
) -> DataFrame:
    """Packed rows: (grp, pack, n_tokens, ids, positions, cu_seqlens, doc_ids, first_tokens).

    `ids` and `positions` are `capacity` little-endian int32 numbers each, as one binary value (`pad` and 0
    after the last segment); `cu_seqlens` begins with 0 and ends with `n_tokens`. Documents without tokens (NULL or empty
    text) are in no row. NULL ids stay NULL; repeated rows are packed each. Other columns are
    ignored; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-total // (4 * GROUP_TOKENS)))  # a token takes four bytes or so
    kind = docs.schema[id_col].dataType
    schema = (
        "grp int, pack int, n_tokens int, ids binary, positions binary, cu_seqlens array<int>, "
        f"doc_ids array<{kind.simpleString()}>, first_tokens array<int>"
    )
    dealt = token_ids(rows, path).where(F.octet_length("ids") > 0).withColumn("grp", F.pmod("h", F.lit(groups)).cast("int"))
    dealt = dealt.repartitionById(groups, F.col("grp"))
    return dealt.groupBy("grp").applyInArrow(_pack(capacity, pad, to_arrow_type(kind)), schema)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet, ids and positions as the rows of int32 matrices."""
    packed.write.parquet(path)
