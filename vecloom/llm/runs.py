"""Places and running sums within groups that may be larger than a task.

Rows are dealt out by ranges of their order, group first. Each task numbers its rows and runs
its sums; a group that goes on in the next task takes with it what came before. That is one
row for each task, summed on the driver and sent back by a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.session import materialize, ship_package

MASK = (1 << 62) - 1  # sums are modulo 2^62, so that adding two of them stays within a long


def _numbered(group: str, sums: list[str], keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, count, totals = None, 0, [np.uint64(0)] * len(sums)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            groups, index = batch[group].to_numpy(), np.arange(n)
            new = np.r_[groups[0] != last, groups[1:] != groups[:-1]]
            begin = np.maximum.accumulate(np.where(new, index, -1))
            goes_on = begin < 0
            at = np.where(goes_on, index + count, index - begin)
            columns = []
            for k, name in enumerate(sums):
                values = batch[name].to_numpy().view(np.uint64)
                run_sum = np.cumsum(values, dtype=np.uint64)
                first = np.maximum(begin, 0)
                run_sum = np.where(goes_on, run_sum + totals[k], run_sum - run_sum[first] + values[first])
                totals[k] = run_sum[-1]
                columns.append(pa.array((run_sum & np.uint64(MASK)).view(np.int64)))
            last, count = groups[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part), pa.int32()), batch[group], pa.array(at), *columns, *(batch[c] for c in keep)],
                names=["part", group, "at", *(f"sum_{c}" for c in sums), *keep],
            )

    return run


def numbered(rows: DataFrame, group: str, order: list[str], sums: list[str], keep: list[str]) -> DataFrame:
    """(group, at, sum_x of each of `sums`, keep): place from 0 and sums up to the row, modulo 2^62.

    `order` begins with `group`, a long without NULLs; NULLs of other columns come first. `sums` and `keep` are
    longs without NULLs. Rows that are equal in `order` lie in one task.
    """
    spark = rows.sparkSession
    ship_package(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    fields = ["part int", *(f"{c} long" for c in (group, "at", *(f"sum_{c}" for c in sums), *keep))]
    pieces = dealt.mapInArrow(_numbered(group, sums, keep), ", ".join(fields))
    pieces = materialize(pieces, "runs")

    totals = ["at", *(f"sum_{c}" for c in sums)]
    edges = pieces.groupBy("part").agg(F.min(group).alias("first"), F.max(F.struct(group, *totals)).alias("last"))
    carried, before = [], None
    for edge in edges.orderBy("part").collect():  # one row a task
        last = [edge["last"]["at"] + 1, *edge["last"][2:]]
        if before is not None and before[0] > edge["first"]:
            raise RuntimeError("the ranges are out of order")
        if before is not None and before[0] == edge["first"]:
            carried.append((edge["part"], edge["first"], *before[1]))
            if edge["last"][0] == edge["first"]:
                last = [(a + b) & MASK for a, b in zip(last, before[1], strict=True)]
        before = (edge["last"][0], last)
    if not carried:
        return pieces.drop("part")
    names = ["part", group, *(f"carried_{c}" for c in totals)]
    schema = ", ".join(f"{c} {'int' if c == 'part' else 'long'}" for c in names)
    joined = pieces.join(F.broadcast(spark.createDataFrame(carried, schema)), ["part", group], "left")
    added = lambda c: (F.col(c) + F.coalesce(f"carried_{c}", F.lit(0))).bitwiseAND(F.lit(MASK)).alias(c)
    return joined.select(group, *map(added, totals), *keep)
