"""Operator 8: similarity self-join of documents on word n-gram sets, by grouped prefixes.

Two documents link when 100 * |A & B| >= percent * |A | B|. With the shingles of all documents
in one order, rarest first, a pair that links shares a shingle among the first
n - ceil(percent% of n) + 1 of each. Documents with the same such prefix and the same size form
one group; group pairs that share a prefix shingle and whose sizes allow a link are candidates,
which are then expanded to their members and verified on the whole sets.

How it scales:

- Shingle counts are dealt out as packed hashes by block and bucket (`blocks`), so a frequent
  shingle costs one number for each block. A document whose prefix holds only shingles that occur
  once links with nothing and leaves there; its set is not moved.
- Equal sets are one node. Nodes are first compared with one hub each, the likely original of
  what they are copies of, twice; components are found, and only candidates whose ends are not
  yet in one component are verified after that. So a group of n copies costs about n
  comparisons, and no link between components is lost.
- Sets, links and components stay in Spark tables in the shared folder.

Sets hold 64-bit hashes of shingles; equal hashes count as equal shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vecloom.llm import blocks
from vecloom.llm.components import components
from vecloom.llm.kept import release
from vecloom.llm.wordhash import U64, mix, ngrams, slices, whole
from vecloom.session import materialize, ship_package

WIDTH = 32


def _shingles(words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each n-gram of each text; a shorter text is one shingle as a whole."""
    grams, valid = ngrams(hashes, n), whole(words, n)
    rows, grams = words.row[: len(grams)][valid], grams[valid]
    for row in np.flatnonzero((words.count > 0) & (words.count < n)):
        part = hashes[words.first[row] : words.first[row + 1]]
        rows, grams = np.append(rows, row), np.append(grams, ngrams(part, len(part)))
    order = np.argsort(rows, kind="stable")
    return rows[order], grams[order]


def _at_least(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-n * percent // 100)


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _emit(n: int, bits: int):
    def run(key, table):
        release()
        found = [
            _shingles(w, w.hashes(), n)[1]
            for chunk in table["text"].chunks
            for _, _, w in slices(chunk, True)
        ]
        every = np.concatenate(found) if found else np.zeros(0, U64)
        return blocks.packed(key[0].as_py(), every, bits, WIDTH)

    return run


SETS_SCHEMA = "doc_id {}, text_hash long, n_shingles long, node long, grp long, prefix array<long>, skip int, common double, tokens binary"


_COLUMNS = {
    "n_shingles": pa.int64(), "node": pa.int64(), "grp": pa.int64(), "prefix": pa.list_(pa.int64()),
    "skip": pa.int32(), "common": pa.float64(), "tokens": pa.binary(),
}


def _sets(n: int, percent: int, bits: int, id_type: pa.DataType):
    def run(_, table, known):
        release()
        recurring = blocks.Recurring(known, bits, WIDTH)
        schema = pa.schema([("doc_id", id_type), ("text_hash", pa.int64()), *_COLUMNS.items()])
        made = []
        for batch in table.select(["doc_id", "text_hash", "text"]).to_batches():
            for low, high, words in slices(batch["text"], True):
                out = {k: [] for k in _COLUMNS}
                rows, grams = _shingles(words, words.hashes(), n)
                cut = np.searchsorted(rows, np.arange(high - low + 1))
                times = recurring.counts(grams)
                for i in range(high - low):
                    _one(out, grams[cut[i] : cut[i + 1]], times[cut[i] : cut[i + 1]], percent)
                # A batch for each slice: the result goes back in small parts.
                part = batch.slice(low, high - low)
                columns = [part["doc_id"].cast(id_type), part["text_hash"]]
                columns += [pa.array(out[k], kind) for k, kind in _COLUMNS.items()]
                made.append(pa.RecordBatch.from_arrays(columns, schema=schema))
        return pa.Table.from_batches(made, schema)

    return run


def _one(out: dict, grams: np.ndarray, times: np.ndarray, percent: int) -> None:
    """The row of one document; those that link with nothing carry no set."""
    tokens, at = np.unique(grams, return_index=True)
    size = len(tokens)
    out["n_shingles"].append(size)
    prefix = size - int(_at_least(size, percent)) + 1
    times = times[at]
    if not size or np.count_nonzero(times == 0) >= prefix:
        for k in ("node", "grp", "prefix", "skip", "common", "tokens"):
            out[k].append(None)
        return
    first = np.lexsort((tokens, times))[:prefix]
    head, several = tokens[first], times[first] > 0
    fold = mix(np.array([size], U64))
    sums = np.array([tokens.sum(dtype=U64) ^ fold[0], np.bitwise_xor.reduce(tokens)])
    out["node"].append(int(ngrams(mix(sums), 2).view(np.int64)[0]))
    out["grp"].append(int(mix(ngrams(head, len(head)) ^ fold).view(np.int64)[0]))
    out["prefix"].append(head[several].view(np.int64))
    out["skip"].append(int(prefix - np.count_nonzero(several)))
    out["common"].append(float(np.log2(times.astype(np.float64) + 1).mean()))
    out["tokens"].append(tokens.tobytes())


def _verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those of the node pairs (a, b) that link."""
    sets = nodes.select("node", "tokens")
    both = pairs.join(sets.withColumnsRenamed({"node": "a", "tokens": "x"}), "a").join(
        sets.withColumnsRenamed({"node": "b", "tokens": "y"}), "b"
    )

    def check(batches):
        for batch in batches:
            x, y = batch["x"].to_pylist(), batch["y"].to_pylist()
            good = [links(np.frombuffer(p, U64), np.frombuffer(q, U64), percent) for p, q in zip(x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _labelled(narrow: DataFrame, found: DataFrame) -> DataFrame:
    """Narrow nodes with the component (`part`) found so far."""
    known = components(found)
    return narrow.join(known, "node", "left").withColumn("part", F.coalesce("root", "node")).drop("root")


def _mixed_posts(labelled: DataFrame, *columns: str) -> DataFrame:
    """(token, part, ...) of the prefix shingles that come up in more than one component."""
    posts = labelled.select(F.posexplode("prefix").alias("at", "token"), "part", *columns)
    mixed = posts.groupBy("token").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q")
    return posts.join(mixed.select("token"), "token")


def _near(a: str, b: str, percent: int):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _to_hubs(labelled: DataFrame, percent: int) -> DataFrame:
    """One candidate pair for each node: with the hub that it shares most prefix shingles with.

    The hub of a shingle is the node whose shingles are the most frequent ones on the whole:
    the text that the others are copies of. So a group of copies is compared with its hub,
    not with itself.
    """
    posts = _mixed_posts(labelled, "node", "n_shingles", "common")
    hubs = posts.groupBy("token").agg(F.max(F.struct("common", "n_shingles", "node", "part")).alias("h"))
    met = posts.join(hubs, "token").select(
        F.col("node").alias("a"), "part", "n_shingles", F.col("h.node").alias("b"),
        F.col("h.part").alias("hub_part"), F.col("h.n_shingles").alias("hub_n"),
    )
    met = met.where((F.col("part") != F.col("hub_part")) & _near("n_shingles", "hub_n", percent))
    counted = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("a").agg(F.max(F.struct("n", "b")).alias("s")).select("a", F.col("s.b").alias("b"))


def _crossing(labelled: DataFrame, percent: int) -> DataFrame:
    """All candidate node pairs between components: prefix shingle shared, sizes near enough.

    Groups of one prefix and size meet first, and are then expanded to their members.
    """
    groups = labelled.groupBy("grp", "part").agg(
        F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"), F.first("skip").alias("skip")
    )
    # What a set has from this shingle on, the ones that occur once before it aside.
    posts = _mixed_posts(groups, "grp", "n", "skip").withColumn("rest", F.col("n") - F.col("skip") - F.col("at"))
    left = posts.select("token", *(F.col(c).alias(f"{c}1") for c in ("grp", "part", "n", "rest")))
    right = posts.select("token", *(F.col(c).alias(f"{c}2") for c in ("grp", "part", "n", "rest")))
    # At the first shingle that two sets share, both must have enough left.
    least = (F.col("n1") + F.col("n2")) * percent
    enough = F.least("rest1", "rest2") * (100 + percent) >= least
    pairs = left.join(right, "token").where((F.col("part1") < F.col("part2")) & _near("n1", "n2", percent) & enough)
    pairs = pairs.select("grp1", "part1", "grp2", "part2").distinct()
    members = labelled.select("grp", "part", "node")
    one = members.withColumnsRenamed({"grp": "grp1", "part": "part1", "node": "a"})
    other = members.withColumnsRenamed({"grp": "grp2", "part": "part2", "node": "b"})
    inside = one.join(other, (F.col("grp1") == F.col("grp2")) & (F.col("part1") < F.col("part2"))).select("a", "b")
    return pairs.where("grp1 <> grp2").join(one, ["grp1", "part1"]).join(other, ["grp2", "part2"]).select(
        "a", "b"
    ).unionByName(inside)


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80, n: int = 5
) -> DataFrame:
    """(doc_id, n_shingles, component_id, group_key, text_hash) of every row of `docs`.

    Words are what stands between white space, A-Z lower-cased; a text of fewer than n words is
    one shingle. NULL or wordless texts have size 0, link with nothing and are their own
    component. `group_key` is one number for each component of rows that may link, else NULL.
    `component_id` is the smallest id reachable by links (NULL ids aside: a component
    of rows without ids has NULL). Repeated rows are copies of each other and all returned.
    Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    total = blocks.text_bytes(rows, "text")
    bits = blocks.bucket_bits(total)
    dealt = blocks.blocked(rows, total, ["doc_id", "text", "text_hash"])
    sent = dealt.groupBy("block").applyInArrow(_emit(n, bits), blocks.COUNTS_SCHEMA)
    known = blocks.recurring(sent, WIDTH)
    schema = SETS_SCHEMA.format(kind.simpleString())
    sets = dealt.groupBy("block").cogroup(blocks.beside(known, total)).applyInArrow(
        _sets(n, percent, bits, to_arrow_type(kind)), schema
    )
    sets = materialize(sets, "shingle-sets")

    firsts = sets.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    nodes = sets.where("node is not null").drop("doc_id", "text_hash").dropDuplicates(["node"])
    nodes = materialize(nodes, "nodes")
    narrow = nodes.select("node", "n_shingles", "grp", "prefix", "skip", "common")
    found, labelled = None, narrow.withColumn("part", F.col("node"))
    for candidates in (_to_hubs, _to_hubs, _crossing):
        more = materialize(_verified(candidates(labelled, percent), nodes, percent), "links")
        found = more if found is None else found.unionByName(more)
        if candidates is _to_hubs:
            labelled = materialize(_labelled(narrow, found), "labelled")
    known = components(found)
    linked = firsts.join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = materialize(linked.join(least, "root").select("node", "root", "component_id"), "component-ids")
    return sets.select("doc_id", "n_shingles", "node", "text_hash").join(by_node, "node", "left").select(
        F.col("doc_id").alias(id_col),
        "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("root").alias("group_key"),
        "text_hash",
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80, n: int = 5) -> DataFrame:
    """`docs` with one row left of each component: that of the smallest id (then text hash).

    Rows that can link with nothing, wordless ones among them, all stay. Of repeated rows of a
    component one stays. All columns stay.
    """
    labels = similar_documents(docs, id_col, text, percent, n).where("group_key is not null")
    labels = materialize(labels.select(F.col(id_col).alias("__id"), "text_hash", "group_key"), "groups")
    order = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("text_hash").alias("h"))
    first = labels.groupBy("group_key").agg(F.min(order).alias("first"))
    marked = (
        labels.join(first, "group_key")
        .groupBy("__id", "text_hash")
        .agg(F.max(order == F.col("first")).alias("__stays"))
        .withColumnRenamed("text_hash", "__hash")
    )
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(id_col).alias("own_id"),
        F.xxhash64(text).alias("own_hash"),
    )
    same = F.col("own_id").eqNullSafe(F.col("__id")) & (F.col("own_hash") == F.col("__hash"))
    joined = rows.join(marked, same, "left")
    alone = joined.where(F.col("__stays").isNull()).select("row.*")
    kept = joined.where("__stays").dropDuplicates(["__id", "__hash"]).select("row.*")
    return alone.unionByName(kept)
