"""Course-reserve reports: checkouts per reserved item and course.

All four work the same way. Courses, reserves and items are first condensed to distinct
keys with a count of the rows behind each, loans to a count per item. The joins then run
on condensed rows, and a report row's checkout count is the product of the counts: as if
every version had been joined to every loan, at none of the cost.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.operators import (
    PERMANENT, Window, conform, count_checkouts, count_checkouts_per_window, count_versions,
    current_only, date_literal, exclude_courses, is_on, item_facts, keep_keys,
    match_course_codes, ordered, resolve_terms, skew_join, term_window,
)
from shelfmark.sources import Tables

FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"

# Result columns and types.
QUARTER_SCHEMA = (
    ("course_term", "string"),
    ("course_number", "string"),
    ("item_barcode", "string"),
    ("call_number", "string"),
    ("instance_title", "string"),
    ("checkout_count", "bigint"),
    ("course_listing_id", "string"),
    ("item_id", "string"),
)
DATED_SCHEMA = (
    ("course_term", "string"),
    ("course_number", "string"),
    ("item_barcode", "string"),
    ("call_number", "string"),
    ("instance_title", "string"),
    ("checkout_count", "bigint"),
    ("is_current", "int"),
    ("course_listing_id", "string"),
    ("item_id", "string"),
    ("reserves_start_date", "date"),
    ("reserves_end_date", "date"),
)
RESERVE_DATES = ("start_date", "end_date", "__current")


def reserves_permanent(
    tables: Tables,
    start_date: str = FIRST_DAY,
    end_date: str = LAST_DAY,
    exclusions: str | None = None,
    show_historical: str | bool | None = None,
    course_codes: str | DataFrame | None = None,
    sort: bool = True,
) -> DataFrame:
    """Checkouts between two dates for courses whose term is the permanent one."""
    courses = _chosen(tables, exclusions, course_codes)
    resolved = _resolved(tables, courses).where(F.col("course_term") == PERMANENT)
    reserves = _of_courses(courses, current_only(tables["reserves"], show_historical))
    window = Window(date_literal(start_date), date_literal(end_date))
    rows = _on_reserve(resolved, reserves, RESERVE_DATES)
    rows = _with_checkouts(tables, rows, window, _items(reserves))
    return _dated_result(rows, _total(F.col("checkouts")), sort)


def reserves_quarter(
    tables: Tables,
    term_name: str | None = None,
    start_date: str = FIRST_DAY,
    end_date: str = LAST_DAY,
    exclusions: str | None = None,
    show_historical: str | bool | None = None,
    sort: bool = True,
) -> DataFrame:
    """Checkouts within a named term's dates, or two given dates, for all courses."""
    courses = _chosen(tables, exclusions)
    resolved = _resolved_for_term(tables, courses, term_name, _allowed_terms(term_name))
    reserves = _of_courses(courses, current_only(tables["reserves"], show_historical))
    window = term_window(tables["terms"], term_name, start_date, end_date)
    rows = _on_reserve(resolved, reserves)
    rows = _with_checkouts(tables, rows, window, _items(reserves))
    result = rows.withColumn("checkout_count", _total(F.col("checkouts")))
    result = conform(result.select(*(n for n, _ in QUARTER_SCHEMA)), QUARTER_SCHEMA)
    return ordered(result, ["course_term"], sort)


def reserves_quarter_course(
    tables: Tables,
    course_codes: str | DataFrame | None = None,
    term_name: str | None = None,
    start_date: str = FIRST_DAY,
    end_date: str = LAST_DAY,
    exclusions: str | None = None,
    show_historical: str | bool | None = None,
    sort: bool = True,
) -> DataFrame:
    """Checkouts for some courses, each row within the dates of its own term.

    A term without dates falls back to the window of the named term or given dates.
    """
    courses = _chosen(tables, exclusions, course_codes)
    allowed = None if is_on(show_historical) else _allowed_terms(term_name)
    resolved = _resolved_for_term(tables, courses, term_name, allowed)
    window = term_window(tables["terms"], term_name, start_date, end_date)
    resolved = resolved.select(
        "*",
        F.coalesce("term_start", window.start).alias("window_start"),
        F.coalesce("term_end", window.end).alias("window_end"),
    )
    reserves = _of_courses(courses, current_only(tables["reserves"], show_historical))
    rows = _on_reserve(resolved, reserves, RESERVE_DATES)
    checkouts = count_checkouts_per_window(
        tables["loans"], _windows(tables["terms"], allowed, window)
    )
    rows = skew_join(rows, item_facts(tables, _items(reserves)), ["item_id"])
    rows = skew_join(rows, checkouts, ["item_id", "window_start", "window_end"])
    return _dated_result(rows, _total(F.col("checkouts")), sort)


def reserves_listings_only(
    tables: Tables,
    start_date: str = FIRST_DAY,
    end_date: str = LAST_DAY,
    term_name: str | None = None,
    course_codes: str | DataFrame | None = None,
    exclusions: str | None = None,
    show_historical_reserves: str | bool | None = None,
    show_historical_checkouts: str | bool | None = None,
    sort: bool = True,
) -> DataFrame:
    """Checkouts of all times for reserves without a start date.

    The dates are accepted and unused. Course codes lift the term filter and both
    current-only filters.
    """
    by_code = isinstance(course_codes, DataFrame) or (course_codes or "").strip(" ") != ""
    one_term = not by_code and _names_term(term_name)
    courses = _chosen(tables, exclusions, course_codes, law_keeps_unnumbered=True)
    resolved = _resolved(tables, courses, [term_name] if one_term else None)
    if one_term:
        resolved = resolved.where(F.col("course_term").isNotNull())
    undated = tables["reserves"].where(F.col("start_date").isNull())
    reserves = _of_courses(
        courses, current_only(undated, by_code or is_on(show_historical_reserves))
    )
    rows = _on_reserve(resolved, reserves, RESERVE_DATES)
    rows = _with_checkouts(tables, rows, None, _items(reserves))
    total = _total(F.col("checkouts"))
    if not (by_code or is_on(show_historical_checkouts)):
        total = F.when(F.col("__current"), total).otherwise(0)
    return _dated_result(rows, total, sort)


def _names_term(term_name: str | None) -> bool:
    return term_name is not None and term_name != ""


@dataclass(frozen=True)
class _Courses:
    rows: DataFrame
    filtered: bool


def _chosen(
    tables: Tables,
    exclusions: str | None,
    course_codes: str | DataFrame | None = None,
    law_keeps_unnumbered: bool = False,
) -> _Courses:
    """The courses a report is about. The filters look at the course number alone, so they
    may come before terms are found: courses that lend each other a term share the number."""
    everything = tables["courses"]
    rows = exclude_courses(everything, exclusions, law_keeps_unnumbered=law_keeps_unnumbered)
    rows = match_course_codes(rows, course_codes)
    return _Courses(rows, rows is not everything)


def _resolved(
    tables: Tables,
    courses: _Courses,
    allowed: Sequence[str] | None = None,
    preferred: str | None = None,
) -> DataFrame:
    return resolve_terms(
        courses.rows, tables["course_listings"], tables["terms"], allowed, preferred
    )


def _allowed_terms(term_name: str | None) -> list[str] | None:
    """A named term shares its reserves with the permanent one; no name allows all."""
    return [term_name, PERMANENT] if _names_term(term_name) else None


def _resolved_for_term(
    tables: Tables, courses: _Courses, term_name: str | None, allowed: Sequence[str] | None
) -> DataFrame:
    """Terms of the courses, the named term first; if one is named, courses without any
    allowed term are dropped."""
    resolved = _resolved(tables, courses, allowed, term_name)
    if _names_term(term_name):
        resolved = resolved.where(F.col("course_term").isNotNull())
    return resolved


def _on_reserve(
    resolved: DataFrame, reserves: DataFrame, kept: Sequence[str] = ()
) -> DataFrame:
    """Courses with their reserved items; reserves are condensed to the ``kept`` columns."""
    condensed = count_versions(
        reserves, ["course_listing_id", "item_id", *kept], "reserve_versions"
    )
    return resolved.join(condensed, "course_listing_id")


def _of_courses(courses: _Courses, reserves: DataFrame) -> DataFrame:
    """Reserves with an item, cut to the chosen courses' listings if some were chosen."""
    reserves = reserves.where(F.col("item_id").isNotNull())
    return keep_keys(
        reserves, courses.rows.select("course_listing_id") if courses.filtered else None
    )


def _items(reserves: DataFrame) -> DataFrame:
    """The items on reserve: far fewer than there are, as a rule."""
    return reserves.select("item_id")


def _with_checkouts(
    tables: Tables, rows: DataFrame, window: Window | None, items: DataFrame
) -> DataFrame:
    facts = item_facts(tables, items, count_checkouts(tables["loans"], window))
    return skew_join(rows, facts, ["item_id"])


def _total(checkouts: Column) -> Column:
    """Zero for unknown items and for items without a checkout."""
    versions = F.col("course_versions") * F.col("reserve_versions") * F.col("item_versions")
    return F.coalesce(checkouts * versions, F.lit(0))


def _dated_result(rows: DataFrame, total: Column, sort: bool) -> DataFrame:
    result = rows.select(
        "course_term", "course_number", "item_barcode", "call_number", "instance_title", total,
        F.when(F.col("__current"), 1).otherwise(0), "course_listing_id", "item_id",
        "start_date", "end_date",
    )
    return ordered(conform(result, DATED_SCHEMA), ["course_term"], sort)


def _windows(terms: DataFrame, allowed: Sequence[str] | None, window: Window) -> DataFrame:
    """Every window a row can get: the allowed terms', with ``window`` where dates lack."""
    if allowed is not None:
        terms = terms.where(F.col("name").isin(list(allowed)))
    undated = terms.sparkSession.range(1).select(
        F.lit(None).cast("date").alias("start_date"), F.lit(None).cast("date").alias("end_date")
    )
    return terms.select("start_date", "end_date").unionAll(undated).select(
        F.coalesce("start_date", window.start).alias("window_start"),
        F.coalesce("end_date", window.end).alias("window_end"),
    )
