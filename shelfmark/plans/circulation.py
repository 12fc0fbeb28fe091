"""Reports on check-ins and loans of items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions import matches_regex, within_midnights
from shelfmark.operators import (
    conform, count_loans, date_literal, keep_keys, known_items, never_checked_in, ordered,
    skew_join, with_titles,
)
from shelfmark.operators.loans import WAS_AVAILABLE, WAS_CHECKED_OUT
from shelfmark.sources import Tables

FIRST_DAY, LAST_DAY = "2000-01-01", "2099-01-01"

# Fixed value: the location whose unused items are listed by default.
ZERO_USE_LOCATION = "59788294-9e3c-5b48-97d7-280067071b70"

# Result columns and types.
CIRC_STATS_SCHEMA = (
    ("item_barcode", "string"), ("instance_title", "string"), ("circ_count", "bigint"),
)
CHECK_IN_SCHEMA = (("check_in_id", "string"), ("check_in_date", "date"))
INTERNAL_USE_SCHEMA = (("internal_use_count", "int"),)
ZERO_USE_SCHEMA = (("item_id", "string"), ("title", "string"))


def circ_stats_course_reserves(
    tables: Tables,
    circ_stat_course_name: str,
    start_date: str = FIRST_DAY,
    end_date: str = LAST_DAY,
    sort: bool = True,
) -> DataFrame:
    """Loans of the items on reserve for courses whose name matches a pattern."""
    courses = tables["courses"].where(
        matches_regex(F.col("name"), circ_stat_course_name)
    ).select("course_listing_id")
    reserved = keep_keys(
        tables["reserves"].where(F.col("item_id").isNotNull()), courses
    ).select("item_id").distinct()
    counts = count_loans(tables["loans_items"], start_date, end_date).where(F.col("loans") >= 1)
    items = known_items(tables, ["item_id", "barcode", "holdings_record_id"])
    # All three are by item: one shuffle each, and only lent reserved items go on.
    rows = (
        with_titles(tables, reserved.join(counts, "item_id").join(items, "item_id", "left"))
        .select("barcode", "instance_title", "loans").distinct()
    )
    return ordered(conform(rows, CIRC_STATS_SCHEMA), ["instance_title"], sort)


def circulation_history(
    tables: Tables,
    barcode_to_check: str | DataFrame,
    start_date: str = FIRST_DAY,
    end_date: str = LAST_DAY,
) -> DataFrame:
    """Check-ins that ended a loan of the item with a barcode.

    Given a DataFrame with a ``barcode`` column, reports on all of them and adds the
    barcode to the result.
    """
    events = _check_ins(tables, WAS_CHECKED_OUT).where(
        within_midnights(
            F.col("occurred_date_time"), date_literal(start_date), date_literal(end_date)
        )
    )
    rows = _of_items(events, _current_items(tables, barcode_to_check))
    if isinstance(barcode_to_check, DataFrame):
        found = rows.select("id", "occurred_date_time", "barcode")
        return conform(found, [*CHECK_IN_SCHEMA, ("barcode", "string")])
    return conform(rows.select("id", "occurred_date_time"), CHECK_IN_SCHEMA)


def internal_use_count(tables: Tables, barcode_to_check: str) -> DataFrame:
    """How often the item with a barcode was checked in without having been lent."""
    events = _check_ins(tables, WAS_AVAILABLE)
    rows = _of_items(events, _current_items(tables, barcode_to_check))
    return conform(rows.agg(F.count("id")), INTERNAL_USE_SCHEMA)


def internal_use_by_item(tables: Tables, barcodes: DataFrame | None = None) -> DataFrame:
    """``internal_use_count`` for all current barcodes at once, or for those given.

    Check-ins are counted per item before the join, whatever share one item has.
    """
    counts = _check_ins(tables, WAS_AVAILABLE).groupBy("item_id").agg(F.count("id").alias("n"))
    rows = (
        skew_join(_current_items(tables, barcodes), counts, ["item_id"])
        .groupBy("barcode").agg(F.coalesce(F.sum("n"), F.lit(0)))
    )
    return conform(rows, [("barcode", "string"), *INTERNAL_USE_SCHEMA])


def zero_use_items(
    tables: Tables,
    start_date: str = FIRST_DAY,
    end_date: str = LAST_DAY,
    location_id: str = ZERO_USE_LOCATION,
) -> DataFrame:
    """Current items of a location without a check-in between two dates."""
    holdings = tables["holdings_history"].where(
        F.col("permanent_location_id") == location_id.strip().lower()
    ).select(F.col("id").alias("holdings_record_id"), "instance_id")
    items = tables["item_history"].where(F.col("__current")).select(
        F.col("id").alias("item_id"), "holdings_record_id"
    ).join(holdings, "holdings_record_id")
    used = tables["check_ins"].where(
        within_midnights(
            F.col("occurred_date_time"), date_literal(start_date), date_literal(end_date)
        )
    )
    titles = tables["instance_history"].select(F.col("id").alias("instance_id"), "title")
    rows = never_checked_in(items, used).join(titles, "instance_id")
    return conform(rows.select("item_id", "title"), ZERO_USE_SCHEMA)


def _check_ins(tables: Tables, previous_status: str) -> DataFrame:
    return tables["check_ins"].where(F.col("item_status_prior_to_check_in") == previous_status)


def _current_items(tables: Tables, barcodes: str | DataFrame | None) -> DataFrame:
    """``item_id, barcode`` of the current items with one, some or any barcode."""
    items = tables["item_history"].where(F.col("__current"))
    wanted: Column = F.col("barcode").isNotNull()
    if isinstance(barcodes, str):
        wanted = F.col("barcode") == barcodes
    items = items.where(wanted).select(F.col("id").alias("item_id"), "barcode")
    if isinstance(barcodes, DataFrame):
        items = items.join(barcodes.select("barcode"), "barcode", "left_semi")
    return items


def _of_items(events: DataFrame, items: DataFrame) -> DataFrame:
    """Events of the items. A runtime filter on the items cuts the events before a shuffle;
    both sides come straight from it, so that a hot item's events can be split."""
    return events.join(items, "item_id")
