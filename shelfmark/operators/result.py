"""The shape of a report's result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def conform(df: DataFrame, schema: Sequence[tuple[str, str]]) -> DataFrame:
    """Name and cast the columns of ``df`` by position, like a table-valued function does
    with the columns of its query."""
    if len(df.columns) != len(schema):
        raise ValueError(f"{len(df.columns)} columns for a result of {len(schema)}")
    positional = df.toDF(*(f"_c{i}" for i in range(len(schema))))
    return positional.select(*(
        F.col(f"_c{i}").cast(kind).alias(name) for i, (name, kind) in enumerate(schema)
    ))


def ordered(
    df: DataFrame, keys: Sequence[str], sort: bool = True, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Sort by ``keys``, NULLs last, ties by the other columns from left to right.

    The ties make the order complete, and they let Spark cut the sort into even ranges
    when a large part of the rows shares one key.

    Spark reads the sort's input twice, first to find the ranges. Where that input comes
    from a long scan without a shuffle, ``spread_by`` names columns to shuffle by before,
    so that only the shuffled rows are read again.
    """
    if not sort:
        return df
    if spread_by:
        df = df.repartition(*spread_by)
    ties = [c for c in df.columns if c not in keys]
    return df.orderBy(*(F.col(c).asc_nulls_last() for c in [*keys, *ties]))
