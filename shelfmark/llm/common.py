"""Helpers shared by the text operators: the shared scratch folder, columns, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.operators.joins import skew_join

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def scratch_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only where the setting is absent, as in tests on one machine, a temporary folder is
    made and the setting filled in.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shelfmark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, outlives lost executors, and tells the planner the table's true size.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that on ASCII text, and is much faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def whole(text: Column) -> Column:
    """A text with null as empty."""
    return F.coalesce(text, F.lit(""))


def sized_join(
    rows: DataFrame, counted: DataFrame, on: list[str], count: int, limit: int, how: str = "inner"
) -> DataFrame:
    """Join rows with a table whose rows are counted: by broadcast up to ``limit`` of them,
    beyond that by a shuffle that splits hot keys."""
    if count <= limit:
        return rows.join(F.broadcast(counted), on, how)
    return skew_join(rows, counted, on, how)


#: Edges that one task brings down to a forest.
FOREST_EDGES = 250_000


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of some edges, and the least node that each is connected to."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        least = label.copy()
        for side in (left, right):
            np.minimum.at(least, side, low)
            np.minimum.at(least, label[side], low)
        while (least != least[least]).any():
            least = least[least]
        if (least == label).all():
            return nodes, nodes[label]
        label = least


def forest(edges: DataFrame, tasks: int) -> DataFrame:
    """Edges ``(a, b)`` that connect the same nodes: each task of some edges gives one per node,
    to the least node that it is connected to there."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches if len(x)]
        if held:
            nodes, least = least_reachable(*(np.concatenate(side) for side in zip(*held, strict=True)))
            hung = nodes != least
            yield pa.RecordBatch.from_arrays([pa.array(nodes[hung]), pa.array(least[hung])], ["a", "b"])

    return edges.select("a", "b").repartition(tasks).mapInArrow(task, "a bigint, b bigint")


def components(
    edges: DataFrame, name: str = "components", broadcast_rows: int = 0,
    forest_edges: int = FOREST_EDGES, rounds: int = 50,
) -> DataFrame:
    """Connected components of the undirected edges ``(a, b)``: one ``(id, component)`` each.

    Edges are brought down to a forest first, in tasks of a bounded number of them. If that
    takes one task only, its trees are the components; else ``star_rounds`` join them. The
    component is its smallest id.
    """
    current = staged(edges.where("a <> b").select("a", "b"), f"{name}-edges")
    tasks = max(1, -(-current.count() // forest_edges))
    current = staged(forest(current, tasks), f"{name}-forest")
    if tasks > 1:
        current = star_rounds(current, name, broadcast_rows, rounds)
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)


def star_rounds(current: DataFrame, name: str, broadcast_rows: int, rounds: int) -> DataFrame:
    """Edges from each node to the least node of its component, by large-star and small-star.

    Every node's larger neighbours, then its smaller ones, are hung under the smallest node
    known to it, until nothing changes. A round is two grouped minimums, combined before the
    shuffle, and two joins of edges back to them, in which a hub's edges can be split; the
    minimums, two per edge at most, are broadcast up to ``broadcast_rows``.
    """
    before = None
    count = current.count()
    for _ in range(rounds):
        both = current.select("a", "b").unionAll(
            current.select(F.col("b").alias("a"), F.col("a").alias("b"))
        )
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = (
            sized_join(both.where("b > a"), lowest, ["a"], 2 * count, broadcast_rows)
            .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        )
        large = staged(large, f"{name}-large")
        under = large.groupBy("a").agg(F.min("b").alias("low"))
        small = sized_join(large, under, ["a"], 2 * count, broadcast_rows)
        current = staged(
            small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionAll(under.select("a", F.col("low").alias("b")))
            .distinct(),
            f"{name}-small",
        )
        state = tuple(current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first())
        if state == before:
            return current
        before, count = state, state[0]
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def span_text(spans: Column, kinds: list[str]) -> Column:
    """Spans ``(kind, start, end)`` as ``kind:start:end``, by start, then kind as listed."""
    rank = F.array(*map(F.lit, kinds))
    ordered = F.array_sort(F.transform(spans, lambda span: F.struct(
        span["start"].cast("long").alias("start"), F.array_position(rank, span["kind"]).alias("rank"),
        span["end"].cast("long").alias("end"), span["kind"].alias("kind"),
    )))
    return F.array_join(F.transform(ordered, lambda span: F.concat_ws(
        ":", span["kind"], span["start"].cast("string"), span["end"].cast("string")
    )), ",")


def span_digest(
    docs: DataFrame, spans: Column, base: list[str], kinds: list[str],
    base_spans: Column | None = None,
) -> DataFrame:
    """Counts by base kind, the base spans' SHA-256, and all spans as text, added to ``docs``.

    The base spans are those of the base kinds, among ``base_spans`` where others share them.
    """
    among = spans if base_spans is None else base_spans

    def of(wanted: list[str]) -> Column:
        return F.filter(among, lambda span: span["kind"].isin(wanted))

    return docs.select(
        "doc_id", *(F.size(of([kind])).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(span_text(of(base), kinds), 256).alias("base_sha256"),
        span_text(spans, kinds).alias("spans"),
    )
