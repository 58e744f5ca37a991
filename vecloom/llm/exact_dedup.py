"""Operator 11: exact copies by progressive refinement, with DataFrame functions only.

Texts are equal when identical without white space (`[\\x20\\x09-\\x0D]`). Rows are grouped by the length
of what is left, those of a shared length by the hash of its first HEAD characters, and only
rows that share both have their whole text hashed (SHA-256); equal digests are copies.

How it scales:

- One scan writes (length, head hash) of each row, 16 bytes. The lengths that come up more than
  once are at most the square root of twice the corpus' bytes (n different lengths need
  n * n / 2 bytes), so they are broadcast. Counts are summed in the task before the shuffle.
- A second scan hashes the rows of shared heads. The list of shared heads is broadcast up to
  BROADCAST_HEADS rows; beyond that, rows are joined with it by a shuffle, the heaviest heads aside
  (`skew.join_counted`), so no text of a head that holds many rows is moved.
- From there on only ids, lengths and digests move. A group that holds a third of all rows is
  one row for each task before the shuffle, and its members get their result by a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.skew import join_counted
from vecloom.session import materialize

HEAD = 64
BROADCAST_HEADS = 1_000_000


def normalised(text: Column) -> Column:
    """The text without white space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _sized(rows: DataFrame) -> DataFrame:
    """Length and head hash of `bare`, the text without white space."""
    return rows.withColumn("size", F.octet_length("bare").cast("long")).withColumn(
        "head", F.xxhash64(F.substring("bare", 1, HEAD))
    )


def _shared_heads(sized: DataFrame) -> DataFrame:
    """(size, head, n) of the heads that come up more than once, among lengths that do."""
    lengths = sized.groupBy("size").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("size")
    among = sized.join(F.broadcast(lengths), "size", "left_semi")
    return among.groupBy("size", "head").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def mark_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    carry: bool = False,
    digests: bool = False,
    broadcast_heads: int = BROADCAST_HEADS,
) -> DataFrame:
    """One row for each row of `docs`: (id_col, keep_id, group_size, kept, text_sha256).

    Of equal texts the row with the most characters in the original text stays, then that of the
    smallest id (NULL ids last), then the first one written: exactly one row of each group has
    `kept`, also where whole rows repeat. `keep_id` is the id of the row that stays. NULL counts as
    empty, and empty texts are copies of each other. `text_sha256` is the digest of the text
    without white space: of rows that were compared, or of all with `digests`; else NULL.

    With `carry` there is also `row`, all columns of `docs` as one struct; otherwise its other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    columns = [F.col(id_col).alias("id"), F.length(body).cast("long").alias("n_points")]
    columns += [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []
    bare = normalised(F.col(text)).alias("bare")
    heads = materialize(_shared_heads(materialize(_sized(docs.select(bare)).drop("bare"), "lengths")), "heads")

    whole = _sized(docs.select(*columns, bare))
    if heads.count() <= broadcast_heads:
        compared = whole.join(F.broadcast(heads), ["size", "head"], "left")
    else:
        compared = join_counted(whole, heads, ["size", "head"], "n", docs.count())
    shared = F.col("n").isNotNull()
    digest = F.sha2("bare", 256)
    rows = materialize(
        compared.select(
            "id",
            "n_points",
            *(["row"] if carry else []),
            shared.alias("shared"),
            (digest if digests else F.when(shared, digest)).alias("text_sha256"),
            F.monotonically_increasing_id().alias("tag"),  # fixed by writing it
        ),
        "digests",
    )
    among = rows.where("shared")
    order = F.struct((-F.col("n_points")).alias("n"), F.col("id").isNull().alias("none"), "id", "tag")
    groups = among.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("first"))
    groups = materialize(groups.where("group_size > 1"), "copies")
    joined = join_counted(among, groups, ["text_sha256"], "group_size", among.count())
    several = F.col("group_size").isNotNull()
    names = [F.col("id").alias(id_col)]
    copies = joined.select(
        *names,
        F.when(several, F.col("first.id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (~several | (F.col("first.tag") == F.col("tag"))).alias("kept"),
        "text_sha256",
        *(["row"] if carry else []),
    )
    alone = rows.where("not shared").select(
        *names,
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
        *(["row"] if carry else []),
    )
    return copies.unionByName(alone)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row left of each group of equal texts, as `mark_copies` tells; all columns stay."""
    return mark_copies(docs, id_col, text, carry=True).where("kept").select("row.*")
