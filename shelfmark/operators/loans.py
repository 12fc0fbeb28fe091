"""Counting loans and check-ins per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions import within_days, within_midnights
from shelfmark.operators.terms import Window

# Loan action and previous statuses at check-in.
CHECKED_OUT_ACTION = "checkedout"
WAS_CHECKED_OUT = "Checked out"
WAS_AVAILABLE = "Available"


def count_checkouts(loans: DataFrame, window: Window | None = None) -> DataFrame:
    """Checkouts per item, within the window if there is one.

    Counting before any join combines a popular item's loans inside each scan task.
    """
    checkouts = loans.where(F.col("action") == CHECKED_OUT_ACTION)
    if window is not None:
        checkouts = checkouts.where(
            within_midnights(F.col("loan_date"), window.start, window.end)
        )
    return checkouts.groupBy("item_id").agg(F.count("__id").alias("checkouts"))


def interval_index(windows: DataFrame) -> DataFrame:
    """One row ``(cuts, steps, cover, first, last)`` on the distinct ``(window_start, window_end)``.

    ``cuts`` are the sorted microseconds at which some window begins, or has just ended; between
    two of them the same windows hold, and ``cover`` lists these after each cut. ``steps`` are
    the powers of two of a binary search over the cuts; ``first`` and ``last`` span all windows.
    Windows without a bound, or that end before they start, hold nothing and are left out.
    """
    start, end = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("window_start", "window_end"))
    held = windows.where("window_start <= window_end").select(
        "window_start", "window_end", start.alias("enters"), (end + 1).alias("leaves")
    ).distinct()
    gathered = held.agg(
        F.collect_list(F.struct("enters", "leaves", "window_start", "window_end")).alias("windows"),
        F.array_sort(F.array_union(F.collect_set("enters"), F.collect_set("leaves"))).alias("cuts"),
        F.min("window_start").alias("first"), F.max("window_end").alias("last"),
    )

    def holding(cut: Column) -> Column:
        inside = F.filter("windows", lambda w: (w["enters"] <= cut) & (cut < w["leaves"]))
        return F.transform(inside, lambda w: F.struct(w["window_start"], w["window_end"]))

    bits = F.sequence(F.ceil(F.log2(F.size("cuts") + 1)).cast("int"), F.lit(0))
    return gathered.select(
        "cuts", F.transform(bits, lambda bit: F.pow(F.lit(2), bit).cast("int")).alias("steps"),
        F.transform("cuts", holding).alias("cover"), "first", "last",
    )


def interval_of(moment: Column, cuts: Column, steps: Column) -> Column:
    """How many of the sorted cuts are at or before the moment, by binary search."""
    micros = F.unix_micros(moment.cast("timestamp"))
    # One pass over an array of one element binds the cuts and the moment for the inner lambda.
    bound = F.array(F.struct(cuts.alias("cuts"), steps.alias("steps"), micros.alias("at")))
    return F.transform(bound, lambda index: F.aggregate(
        index["steps"], F.lit(0), lambda found, step: F.when(
            (found + step <= F.size(index["cuts"]))
            & (F.get(index["cuts"], found + step - 1) <= index["at"]), found + step,
        ).otherwise(found),
    ))[0]


def count_checkouts_per_window(loans: DataFrame, windows: DataFrame) -> DataFrame:
    """Checkouts per item within each of the ``(window_start, window_end)`` rows.

    The windows' bounds cut time into elementary intervals. Each loan's interval is found by
    binary search over the cuts, which reach the scan as one array: they are the terms' dates,
    so no more than two per term. Loans are counted per item and interval, combined in the
    scan's own stage, and only these counts are expanded to the windows that hold the interval.
    The span of all windows cuts the scan itself.
    """
    index = interval_index(windows)
    cuts, steps, cover, first, last = (
        index.select(c).scalar() for c in ("cuts", "steps", "cover", "first", "last")
    )
    moment = F.col("loan_date")
    counted = (
        loans.where(F.col("action") == CHECKED_OUT_ACTION)
        .where(within_midnights(moment, first, last))
        .withColumns({"_cuts": cuts, "_steps": steps})
        .withColumn("_interval", interval_of(moment, F.col("_cuts"), F.col("_steps")))
        .groupBy("item_id", "_interval").agg(F.count("__id").alias("_count"))
    )
    held = counted.select(
        "item_id", "_count", F.explode(F.get(cover, F.col("_interval") - 1)).alias("_window")
    )
    return held.groupBy(
        "item_id", F.col("_window.window_start").alias("window_start"),
        F.col("_window.window_end").alias("window_end"),
    ).agg(F.sum("_count").alias("checkouts"))


def count_loans(loans_items: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """Loans per item, first and last day included as a whole."""
    start, end = F.lit(start_date).cast("date"), F.lit(end_date).cast("date")
    return (
        loans_items.where(within_days(F.col("loan_date"), start, end))
        .groupBy("item_id")
        .agg(F.count("loan_id").alias("loans"))
    )


def never_checked_in(items: DataFrame, check_ins: DataFrame) -> DataFrame:
    """The ``(item_id, ...)`` rows of items that no check-in names."""
    return items.join(check_ins.select("item_id").distinct(), "item_id", "left_anti")
