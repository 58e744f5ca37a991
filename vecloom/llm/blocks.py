"""Hash counts over a whole corpus, dealt out twice: by hash to count, by block to use.

A corpus is cut into blocks of texts of about `BLOCK_BYTES`. A block sends each bucket of
the hash space its distinct hashes, packed as one sorted array; a bucket counts and sends each
block those of its hashes that occur more than once in the corpus. No key's rows meet in one
task but as one number for each block, so frequent hashes cost no more than rare ones.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.wordhash import U64

BLOCK_BYTES = 12 << 20
HASHES_PER_BUCKET = 1 << 20
COUNTS_SCHEMA = "block int, bucket int, keys binary, counts binary"


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def n_blocks(total: int) -> int:
    return max(1, -(-total // BLOCK_BYTES))


def blocked(docs: DataFrame, total: int, columns: list[str]) -> DataFrame:
    """`columns` of every row of a stored table, with its `block`; each block is a partition of its own.

    Rows are dealt out by their places in the table, so equal rows part like any others. The
    places of a stored table are the same whenever it is read.
    """
    n = n_blocks(total)
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")
    return docs.select(block.alias("block"), *columns).repartitionById(n, F.col("block"))


def beside(rows: DataFrame, total: int) -> DataFrame:
    """`rows` with a `block`, dealt out like the blocks themselves, for a cogroup without a further shuffle."""
    return rows.repartitionById(n_blocks(total), F.col("block")).groupBy("block")


def bucket_bits(total: int) -> int:
    """So many buckets that one counts about `HASHES_PER_BUCKET` hashes; words take 6 bytes or so."""
    return min(24, max(3, (total // 6 // HASHES_PER_BUCKET).bit_length()))


def packed(block: int, hashes: np.ndarray, bits: int, width: int) -> pa.Table:
    """Rows for the buckets: distinct hashes, cut to `bits + width` leading bits, and their counts."""
    keys = np.sort(hashes >> U64(64 - bits - width))
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[starts, len(keys)])
    keys = keys[starts]
    cuts = np.append(np.searchsorted(keys, np.arange(1 << bits, dtype=U64) << U64(width)), len(keys))
    rows = [b for b in range(1 << bits) if cuts[b] < cuts[b + 1]]
    low = (keys & U64((1 << width) - 1)).astype(np.uint32 if width == 32 else U64)
    data, more = [], []
    for b in rows:
        part = counts[cuts[b] : cuts[b + 1]]
        several = np.flatnonzero(part > 1)
        data.append(low[cuts[b] : cuts[b + 1]].tobytes())
        # Counts over 1, as (place, count).
        more.append(np.stack([several, part[several]]).astype(np.uint32).tobytes())
    return pa.table(
        {
            "block": pa.array([block] * len(rows), pa.int32()),
            "bucket": pa.array(rows, pa.int32()),
            "keys": pa.array(data, pa.binary()),
            "counts": pa.array(more, pa.binary()),
        }
    )


def recurring(rows: DataFrame, width: int, keep: Callable[[np.ndarray], np.ndarray] = lambda n: n > 1) -> DataFrame:
    """For each block, those of its hashes whose count in the corpus passes `keep`, with that count."""
    kind = np.uint32 if width == 32 else U64

    def count(_, table):
        blocks = table["block"].to_pylist()
        bucket = table["bucket"][0].as_py()
        keys = [np.frombuffer(x, kind) for x in table["keys"].to_pylist()]
        times = [np.ones(len(k), np.int64) for k in keys]
        for t, x in zip(times, table["counts"].to_pylist(), strict=True):
            where, n = np.frombuffer(x, np.uint32).reshape(2, -1)
            t[where] = n
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        sums = np.add.reduceat(np.concatenate(times)[order], starts)
        kept = keep(sums)
        found, sums = ranked[starts][kept], np.minimum(sums[kept], 0xFFFFFFFF).astype(np.uint32)
        out = {"block": [], "keys": [], "counts": []}
        for block, k in zip(blocks, keys, strict=True):
            at = np.searchsorted(found, k)
            at[at == len(found)] = 0
            hit = found[at] == k if len(found) else np.zeros(len(k), bool)
            if hit.any():
                out["block"].append(block)
                out["keys"].append(k[hit].tobytes())
                out["counts"].append(sums[at[hit]].tobytes())
        return pa.table(
            {
                "block": pa.array(out["block"], pa.int32()),
                "bucket": pa.array([bucket] * len(out["block"]), pa.int32()),
                "keys": pa.array(out["keys"], pa.binary()),
                "counts": pa.array(out["counts"], pa.binary()),
            }
        )

    return rows.groupBy("bucket").applyInArrow(count, COUNTS_SCHEMA)


class Recurring:
    """What `recurring` found for one block: `counts(hashes)` is 0 where a hash is not among it."""

    def __init__(self, table: pa.Table, bits: int, width: int):
        kind = np.uint32 if width == 32 else U64
        self.shift = U64(64 - bits - width)
        rows = sorted(
            zip(table["bucket"].to_pylist(), table["keys"].to_pylist(), table["counts"].to_pylist(), strict=True)
        )
        high = [(U64(b) << U64(width)) | np.frombuffer(k, kind).astype(U64) for b, k, _ in rows]
        self.keys = np.concatenate(high) if rows else np.zeros(0, U64)
        self.times = np.concatenate([np.frombuffer(c, np.uint32) for *_, c in rows]) if rows else np.zeros(0, np.uint32)
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.times = self.keys[order], self.times[order]

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(hashes), np.uint32)
        keys = hashes >> self.shift
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.times[at], 0)
