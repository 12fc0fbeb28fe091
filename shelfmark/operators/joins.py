"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

_HASH = "_key_hash"


def skew_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join of rows with possibly hot keys to a table already grouped by the key.

    Adaptive execution splits a hot partition only where both inputs of the join come
    straight out of a shuffle. A grouped right side is already partitioned by the key,
    so Spark would join it as it is and leave the hot key to a single task. Joining on
    the key and its hash asks for a fresh shuffle on both sides, and the split applies.
    """
    key_hash = F.xxhash64(*on)
    return (
        left.withColumn(_HASH, key_hash)
        .join(right.withColumn(_HASH, key_hash), [*on, _HASH], how)
        .drop(_HASH)
    )


def keep_keys(df: DataFrame, keys: DataFrame | None) -> DataFrame:
    """Drop rows whose key a later join would drop, before further joins carry them on.

    Without ``keys`` nothing is dropped. The keys are made distinct inside their scan; how
    the join is done is left to Spark, which knows the sizes once they are there.
    """
    return df if keys is None else df.join(keys.distinct(), keys.columns, "left_semi")


def lookup_names(
    df: DataFrame, roles: Sequence[tuple[DataFrame, str, str]]
) -> DataFrame:
    """Add a name column per role ``(lookup, key column, name column)``.

    A missing key gives a NULL name. Lookups carry no broadcast hint: Spark broadcasts
    those under its size threshold and shuffles the others.
    """
    for lookup, key, name in roles:
        names = lookup.select(F.col("id").alias(key), F.col("name").alias(name))
        df = df.join(names, key, "left")
    return df
