"""Exact duplicates by progressive refinement.

Texts are grouped by length, then by a hash of their first characters, and only texts that
still share a group are hashed whole. DataFrame functions only.

Defined results: a null text counts as empty. Of equal texts the row with the largest id
stays; a null id is smaller than any other, and of rows equal in id and text one stays.
Columns of the input other than the id, the text and those asked for are not read. An empty
table gives an empty result, and texts of any length are hashed whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.operators.joins import skew_join
from shelfmark.llm.common import lower_ascii, sized_join, staged, whole

PREFIX_CHARS = 128
#: Rows of a counted table that a join may broadcast, some 50 bytes each.
BROADCAST_ROWS = 500_000


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, in lower-case hex."""
    return F.sha2(lower_ascii(whole(text)), 256)


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: dict[str, Column] | None = None,
    prefix_chars: int = PREFIX_CHARS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per document: the id, ``keep_id``, ``group_size``, ``kept`` and ``carry``.

    Counts of lengths and prefixes are combined before their shuffles. Texts never leave the
    scan: the surviving prefix groups are broadcast up to a counted ``broadcast_rows``, and full
    hashes made of what meets them; beyond that the full hash is made where a text is read, and
    goes to meet the groups in its place. Rows hold a digest from there on, and a group with a
    large share of the rows can be split at every join.
    """
    text = whole(F.col(text_col))
    carried = carry or {}
    rows = docs.select(
        F.col(id_col).alias("_id"), text.alias("_text"),
        *(column.alias(name) for name, column in carried.items()),
        F.char_length(text).alias("_length"),
        F.xxhash64(lower_ascii(F.left(text, F.lit(prefix_chars)))).alias("_prefix"),
    )
    lengths = rows.groupBy("_length").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    prefixes = staged(
        skew_join(rows.select("_length", "_prefix"), lengths, ["_length"], "left_semi")
        .groupBy("_length", "_prefix").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n"),
        "exact-prefixes",
    )
    keys = ["_length", "_prefix"]
    count = prefixes.count()
    digest = F.unhex(text_digest(F.col("_text"))).alias("_full")
    if count <= broadcast_rows:
        met = rows.join(F.broadcast(prefixes), keys, "left_semi").select("_id", *carried, digest)
    else:
        hashed = rows.select("_id", *carried, *keys, digest)
        met = skew_join(hashed, prefixes, keys, "left_semi").select("_id", *carried, "_full")
    survivors = staged(met, "exact-survivors")
    classes = survivors.groupBy("_full").agg(
        F.max("_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    same = Window.partitionBy("_full", "_id").orderBy("_full")
    grouped = skew_join(
        survivors.withColumn("_turn", F.row_number().over(same)), classes, ["_full"], "inner"
    ).select(
        F.col("_id").alias(id_col), "keep_id", "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_turn") == 1)).alias("kept"),
        *carried,
    )
    others = rows.select("_id", *carried, *keys)
    alone = sized_join(others, prefixes, keys, count, broadcast_rows, "left_anti").select(
        F.col("_id").alias(id_col), F.col("_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *carried,
    )
    return grouped.unionAll(alone)


def keep_one_copy(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The documents without all but one of equal texts, columns unchanged.

    Rows to drop are known by id and digest, and are broadcast up to a counted
    ``broadcast_rows``. Of rows repeated with the same id and text any one stays.
    """
    digest = F.unhex(text_digest(F.col(text_col)))
    judged = exact_duplicates(docs, id_col, text_col, {"_digest": digest}, broadcast_rows=broadcast_rows)
    marks = staged(
        judged.where("group_size > 1").groupBy(F.col(id_col).alias("_id"), "_digest").agg(
            F.bool_or("kept").alias("_kept"), F.count("*").alias("_times")
        ).where("not _kept or _times > 1"),
        "exact-marks",
    )
    # The whole row goes along as one column, so that no name can clash.
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("number"), digest.alias("digest")
    )

    few = marks.count() <= broadcast_rows

    def marked(marks: DataFrame, how: str) -> DataFrame:
        same = F.col("number").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
        marks = marks.select("_id", "_digest")
        return rows.join(F.broadcast(marks) if few else marks, same, how)

    once = marked(marks.where("_kept"), "left_semi").dropDuplicates(["number", "digest"])
    return marked(marks, "left_anti").unionAll(once).select("row.*")
