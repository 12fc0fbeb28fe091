"""Running totals along groups of any size, and the ranking of linked lists.

A window over a group brings the group to one task. Here rows are cut into ranges by group and
order, so that a long group goes to many tasks; each task runs through its own range, and what
the ranges before it hold of the same group is added from one small row per range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from shelfmark.llm.common import staged
from shelfmark.operators.joins import skew_join


def _segmented(values: np.ndarray, starts: np.ndarray, ufunc: np.ufunc) -> np.ndarray:
    """Running sums or exclusive ors that begin anew at each start."""
    run = ufunc.accumulate(values)
    sizes = np.diff(np.append(starts, len(values)))
    before = np.where(starts > 0, run[np.maximum(starts - 1, 0)], 0)
    undo = np.subtract if ufunc is np.add else np.bitwise_xor
    return undo(run, np.repeat(before, sizes))


def running(
    rows: DataFrame, group: str, order: Sequence[str], sums: dict[str, str], name: str,
    xors: dict[str, str] | None = None,
) -> DataFrame:
    """``rows`` with the running total of some columns along each group, this row included.

    ``sums`` and ``xors`` give the new column of each bigint column; ``group`` is a bigint
    without nulls, and rows that are alike in group and order come in any order.
    """
    xors = xors or {}
    kinds = [(c, new, np.add) for c, new in sums.items()]
    kinds += [(c, new, np.bitwise_xor) for c, new in xors.items()]
    added = [T.StructField(new, T.LongType()) for _, new, _ in kinds] + [
        T.StructField("_range", T.IntegerType()), T.StructField("_open", T.BooleanType()),
        T.StructField("_close", T.BooleanType()),
    ]
    schema = T.StructType([*rows.schema.fields, *added])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        first = last = waiting = None
        totals = [0] * len(kinds)
        for batch in batches:
            if not len(batch):
                continue
            groups = batch.column(batch.schema.get_field_index(group)).to_numpy()
            starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
            goes_on = last is not None and groups[0] == last
            head = int(starts[1]) if len(starts) > 1 else len(groups)
            columns = []
            for place, (column, _, ufunc) in enumerate(kinds):
                values = batch.column(batch.schema.get_field_index(column)).to_numpy()
                run = _segmented(values, starts, ufunc)
                if goes_on:
                    run[:head] = ufunc(run[:head], totals[place])
                totals[place] = run[-1]
                columns.append(pa.array(run))
            if first is None:
                first = groups[0]
            last = groups[-1]
            if waiting is not None:
                yield waiting
            waiting = pa.RecordBatch.from_arrays(
                [*batch.columns, *columns, pa.array(np.full(len(batch), number, np.int32)),
                 pa.array(groups == first), pa.array(np.zeros(len(batch), bool))],
                names=schema.names,
            )
        if waiting is not None:
            closing = np.zeros(len(waiting), bool)
            closing[-1] = True
            yield waiting.set_column(len(waiting.columns) - 1, "_close", pa.array(closing))

    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.repartitionByRange(ranges, group, *order).sortWithinPartitions(group, *order)
    scanned = staged(cut.mapInArrow(task, schema), name)
    # At most two rows per range: the group that it opens with, and its totals of the last.
    edges = scanned.where("_open").select("_range", group).distinct().select(
        "_range", group, F.lit(0).alias("_kind"), *(F.lit(0).cast("long").alias(new) for _, new, _ in kinds)
    ).unionAll(scanned.where("_close").select(
        "_range", group, F.lit(1).alias("_kind"), *(new for _, new, _ in kinds)
    ))
    earlier = Window.partitionBy(group).orderBy("_range", "_kind").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = edges.select("_range", "_kind", *(
        F.coalesce((F.sum if ufunc is np.add else F.bit_xor)(new).over(earlier), F.lit(0))
        .alias(f"_before_{new}") for _, new, ufunc in kinds
    )).where("_kind = 0").drop("_kind")
    joined = scanned.join(F.broadcast(carried), "_range", "left")

    def whole_run(new: str, ufunc: np.ufunc):
        before = F.col(f"_before_{new}")
        total = F.col(new) + before if ufunc is np.add else F.col(new).bitwiseXOR(before)
        return F.when(F.col("_open"), total).otherwise(F.col(new)).alias(new)

    return joined.select(*rows.columns, *(whole_run(new, ufunc) for _, new, ufunc in kinds))


#: Elements of a list that one task contracts.
BLOCK = 1 << 16


def contract(
    elements: np.ndarray, following: np.ndarray, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For parts of lists: each element's last element here, and the weights up to it and with it.

    ``following`` is -1 at a list's end. Gives, per element, the head of its run, what the
    run's weights before the element sum up to, and the run's next element elsewhere, by
    jumping over ever longer stretches.
    """
    order = np.argsort(elements, kind="stable")
    at = np.searchsorted(elements[order], following)
    at = np.minimum(at, len(elements) - 1)
    inside = (elements[order][at] == following) & (following >= 0)
    follows = np.where(inside, order[at], -1)
    before = np.full(len(elements), -1, np.int64)  # the element here that leads to this one
    before[follows[follows >= 0]] = np.flatnonzero(follows >= 0)
    head = np.where(before >= 0, before, np.arange(len(elements)))
    offset = np.where((before >= 0)[:, None], weights[before], 0)
    while True:
        further = head[head]
        if (further == head).all():
            return head, offset, follows
        offset = offset + offset[head]
        head = further


def rank_list(links: DataFrame, weights: Sequence[str], block: int = BLOCK, rounds: int = 64) -> DataFrame:
    """``(element, *weights)``: the sums of the weights from each element to its list's end.

    ``links`` has an ``element`` and its ``following`` one (null at an end), bigints, and the
    bigint weights. Elements near in number are taken to be near in the list: blocks of them
    are contracted first, and what leads from block to block is ranked by pointer doubling,
    which joins each element with just one other, so no key is hot. All sums include the
    element itself.
    """
    names = list(weights)
    schema = ", ".join([
        "element bigint", "following bigint", "head bigint",
        *(f"{name} bigint" for name in names), *(f"_to_{name} bigint" for name in names),
    ])
    arrow = pa.schema([(field.split()[0], pa.int64()) for field in schema.split(", ")])

    def in_block(table: pa.Table) -> pa.Table:
        elements = table.column("element").to_numpy()
        following = table.column("following").fill_null(-1).to_numpy()
        values = np.stack([table.column(name).to_numpy() for name in names], axis=1)
        head, offset, follows = contract(elements, following, values)
        # A run's total stands at its head: the offset of its last element, and that element.
        ends = np.flatnonzero(follows < 0)
        total = np.zeros_like(values)
        total[head[ends]] = offset[ends] + values[ends]
        leads = np.full(len(elements), -1, np.int64)
        leads[head[ends]] = following[ends]
        at = pa.array(leads, mask=leads < 0)
        return pa.table(
            [pa.array(elements), at, pa.array(elements[head]),
             *(pa.array(total[:, k]) for k in range(len(names))),
             *(pa.array(offset[:, k]) for k in range(len(names)))],
            schema=arrow,
        )

    bucket = F.floor(F.col("element") / block).cast("long")
    parts = staged(
        links.select("element", "following", *names).withColumn("_block", bucket)
        .groupBy("_block").applyInArrow(lambda table: in_block(table.drop_columns(["_block"])), schema),
        "list-blocks",
    )
    state = parts.where("element = head").select("element", "following", *names)
    for _ in range(rounds):
        if state.where("following is not null").isEmpty():
            break
        further = state.select(
            F.col("element").alias("following"), F.col("following").alias("_further"),
            *(F.col(name).alias(f"_more_{name}") for name in names),
        )
        state = staged(
            state.join(further, "following", "left").select(
                "element", F.col("_further").alias("following"),
                *((F.col(name) + F.coalesce(f"_more_{name}", F.lit(0))).alias(name) for name in names),
            ),
            "list-doubling",
        )
    else:
        raise RuntimeError(f"a list did not end in {rounds} rounds of doubling")
    heads = state.select(F.col("element").alias("head"), *(F.col(n).alias(f"_all_{n}") for n in names))
    return skew_join(parts.select("element", "head", *(f"_to_{n}" for n in names)), heads, ["head"], "inner").select(
        "element", *((F.col(f"_all_{n}") - F.col(f"_to_{n}")).alias(n) for n in names)
    )
