"""Operator 13: the trie of conversation prefixes, by collapsing whole sequences.

Conversations that are the same from first to last turn become one weighted sequence with a list of
those that end there. Sequences that are proper prefixes of others are dropped by an anti-join; what is
left are the leaves. Each node then is a sum over the weighted sequences that run through it.

A prefix is told by its length and the sums, modulo 2^62, of two 62-bit hashes of (place, role, text)
of its turns; equal sums count as equal prefixes. Such sums can be run over a conversation that lies on
several tasks (`runs.numbered`), so a conversation of any length is never gathered.

saved_tokens of a node is a sum over the nodes below it, and is also a sum over sequences: the weight
times the bytes from that depth on, minus the bytes of the nodes from there on that the sequence
owns. A node is owned by the sequence with the smallest conversation that runs through it, so what a
sequence owns is the end of its path, and one number for each sequence tells where it begins.

How it scales: after the first sort no text is moved. Distinct sequences are expanded to their prefixes,
which is as many rows as they have turns; prefixes are summed in the task before the shuffle, so
the root or a first turn that everyone shares is one row a task. Joins on a conversation or on a
parent split heavy keys off (`skew.join_counted`). Lists of ends are sorted and joined in
pieces by many tasks. Only the digest of one node's list, which is sequential by its definition,
runs in one task: it reads the finished pieces one after another and keeps none of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.runs import MASK, numbered
from vecloom.llm.skew import join_counted
from vecloom.session import materialize, ship_package

CYCLE, HEADS = 5, 9
PIECE = 1 << 15
NODE = ["depth", "k1", "k2"]


def head_length(conv: Column) -> Column:
    """How many turns the rebuilt conversation takes from its base."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def base_of(conv: Column) -> Column:
    return conv - conv % CYCLE


def turns_in_order(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, at, h1, h2, n_bytes) of every turn; `at` is its place in its conversation, from 0."""
    body, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        who.alias("role"),
        body.alias("text"),
        F.xxhash64(who, body).alias("h1"),
        F.xxhash64(F.lit(1), body, who).alias("h2"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("tag"),  # lets equal rows part
    )
    order = ["conv_id", "turn", "role", "text", "tag"]
    return materialize(numbered(rows, "conv_id", order, [], ["h1", "h2", "n_bytes"]), "turns")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, place, h1, h2, n_bytes) of the rebuilt conversations, their conv_ids).

    The head of conversation c is the first h turns of its base, all if it has fewer, none if there is
    no base; its own turns after its first h follow.
    """
    convs = materialize(turns.groupBy("conv_id").agg((F.max("at") + 1).alias("n_turns")), "conversations")
    own = F.col("conv_id")
    asked = convs.select(own, "n_turns", base_of(own).alias("base"), head_length(own).alias("h"))
    bases = turns.where(F.col("at") < HEADS).select(F.col("conv_id").alias("base"), "at", "h1", "h2", "n_bytes")
    # At most 2 * CYCLE - 1 conversations have one base, and it gives at most HEADS turns.
    heads = bases.join(asked, "base").where("at < h").select("conv_id", F.col("at").alias("place"), "h1", "h2", "n_bytes")
    lengths = convs.select(own.alias("base"), F.col("n_turns").alias("base_turns"))
    lacking = asked.join(lengths, "base", "left").select(
        "conv_id", "n_turns", (F.col("h") - F.coalesce("base_turns", F.lit(0))).alias("lack")
    )
    lacking = materialize(lacking.where("lack > 0"), "short-bases")
    n_rows = turns.count()
    tails = join_counted(turns.where(F.col("at") >= head_length(own)), lacking, ["conv_id"], "n_turns", n_rows)
    place = F.col("at") - F.coalesce("lack", F.lit(0))
    return heads.unionByName(tails.select("conv_id", place.alias("place"), "h1", "h2", "n_bytes")), convs.select(own)


def _steps(places: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, n_bytes, before): each prefix, its parent, its bytes without the last text."""
    mask = F.lit(MASK)
    rows = places.select(
        "conv_id",
        F.col("place").cast("long").alias("place"),
        F.xxhash64("place", "h1", "h2").bitwiseAND(mask).alias("m1"),
        F.xxhash64(F.lit(1), "h2", "h1", "place").bitwiseAND(mask).alias("m2"),
        "n_bytes",
    )
    summed = numbered(rows, "conv_id", ["conv_id", "place"], ["m1", "m2", "n_bytes"], ["m1", "m2", "n_bytes"])
    return materialize(
        summed.select(
            "conv_id",
            (F.col("at") + 1).alias("depth"),
            F.col("sum_m1").alias("k1"),
            F.col("sum_m2").alias("k2"),
            (F.col("sum_m1") - F.col("m1")).bitwiseAND(mask).alias("p1"),
            (F.col("sum_m2") - F.col("m2")).bitwiseAND(mask).alias("p2"),
            "n_bytes",
            (F.col("sum_n_bytes") - F.col("n_bytes")).alias("before"),
        ),
        "prefixes",
    )


def _runs_of(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[pa.RecordBatch, int, int, bool]]:
    """(batch, from, to, whether a new key begins) of rows that are sorted by key."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch[c].to_numpy() for c in columns], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            key = tuple(keys[begin].tolist())
            yield batch, begin, end, key != last
            last = key


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, k1, k2, conv_id) as lists of up to PIECE ids, joined by commas."""
    for batch, begin, end, _ in _runs_of(batches, NODE):
        ids = batch["conv_id"].to_numpy()
        for at in range(begin, end, PIECE):
            part = ids[at : min(at + PIECE, end)]
            columns = [batch[c].slice(at, 1) for c in (*NODE, "conv_id")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([",".join(map(str, part.tolist()))])], names=[*NODE, "first_id", "ids"]
            )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each key of sorted pieces; only the state of the hash is kept."""
    key, state = None, None

    def done() -> pa.RecordBatch:
        columns = [pa.array([v], t) for v, t in zip(key, (pa.int64(),) * 3, strict=True)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([state.hexdigest()])], names=[*NODE, "ends_sha256"])

    for batch, begin, end, new in _runs_of(batches, NODE):
        if new:
            if state is not None:
                yield done()
            key, state = tuple(batch[c][begin].as_py() for c in NODE), None
        for text in batch["ids"].slice(begin, end - begin):
            data = text.as_py().encode()
            if state is None:
                state = hashlib.sha256(data)
            else:
                state.update(b"," + data)
    if state is not None:
        yield done()


def _ends(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the nodes where some conversation ends."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*NODE, "conv_id"]
    dealt = ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)
    names = ", ".join(f"{c} long" for c in NODE)
    pieces = dealt.mapInArrow(_pieces, f"{names}, first_id long, ids string")
    sorted_pieces = pieces.repartition(n, *NODE).sortWithinPartitions(*NODE, "first_id")
    return sorted_pieces.mapInArrow(_digests, f"{names}, ends_sha256 string")


def trie(places: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the conversations `convs` with turns `places` (conv_id, place, h1, h2, n_bytes).

    Places of a conversation run from 0; a conversation without any ends in the root.
    """
    ship_package(places.sparkSession)
    zero = F.lit(0).cast("long")
    steps = _steps(places)
    last = F.max(F.struct("depth", "k1", "k2", (F.col("before") + F.col("n_bytes")).alias("total"))).alias("e")
    ends = convs.join(steps.groupBy("conv_id").agg(last), "conv_id", "left").select(
        "conv_id", *(F.coalesce(f"e.{c}", zero).alias(c) for c in (*NODE, "total"))
    )
    ends = materialize(ends, "ends")

    # Whole-sequence collapse, and which of the sequences are leaves.
    sequences = ends.groupBy(*NODE, "total").agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"))
    sequences = materialize(sequences, "sequences")
    named = sequences.select("conv_id", "weight", "total", F.col("depth").alias("length"))
    n_steps = steps.count()
    inner = join_counted(steps, named, ["conv_id"], "length", n_steps).where("weight is not null")
    roots = named.select(
        "conv_id", *(zero.alias(c) for c in (*NODE, "p1", "p2", "n_bytes", "before")), "weight", "total", "length"
    )
    paths = materialize(inner.unionByName(roots), "paths")
    proper = paths.where("depth < length").select(*NODE).distinct()
    leaves = sequences.join(proper, NODE, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))

    owned = paths.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.min("before").alias("before"))
    starts = owned.groupBy("conv_id").agg(F.min("before").alias("start"))
    of_sequence = named.join(leaves, "conv_id", "left").join(starts, "conv_id", "left")
    of_sequence = materialize(
        of_sequence.select("conv_id", F.coalesce("leaf", zero).alias("leaf"), "start", (F.col("length") + 1).alias("n")),
        "of-sequence",
    )

    # Weighted prefixes.
    weighed = join_counted(paths, of_sequence, ["conv_id"], "n", n_steps)
    below = F.col("weight") * (F.col("total") - F.col("before"))
    once = F.coalesce(F.col("total") - F.greatest("before", "start"), zero)
    once = F.when(F.col("start").isNull(), zero).otherwise(once)
    nodes = weighed.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(below - once).alias("saved_tokens"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
    )
    nodes = materialize(nodes, "nodes")

    parent = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = nodes.where("depth > 0").select(*parent).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, NODE, "left").join(_ends(ends), NODE, "left")
    counted = materialize(
        counted.withColumn("n_children", F.coalesce("n_children", zero)).withColumn(
            "ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
        ),
        "counted",
    )
    out = ["depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    above = counted.where("n_children > 0").select(
        F.col("depth").alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings"),
    )
    below_root = counted.where("depth > 0").select("conv_id", "p1", "p2", (F.col("depth") - 1).alias("d"), *out)
    placed = join_counted(below_root, above, ["d", "p1", "p2"], "siblings", counted.count())
    root = counted.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    names = ["conv_id", "depth", "parent_conv_id", *out[1:]]
    return placed.select(*names).unionByName(root.select(*names))


def prefix_trie(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The trie of the rebuilt conversations, one row for each distinct prefix (role and text of each turn).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): smallest
    member; number of turns; parent's conv_id, NULL for the root; members; children; childless nodes of the
    subtree, itself included; sum over the subtree of (n_convs - 1) times the UTF-8 bytes of the last text
    (none for the root); digest of the conv_ids that end here, ascending, joined by commas.

    Turns go by `turn`, NULL first; of one turn by role, then text, and repeated rows stay as often as
    they come. NULL role or text counts as empty. Rows without a conversation are left out. A
    conversation without turns after rebuilding ends in the root. Other columns are ignored,
    whatever their names. An empty table gives no rows.
    """
    ship_package(turns.sparkSession)
    return trie(*rebuilt_turns(turns_in_order(turns, conv, turn, role, text)))
