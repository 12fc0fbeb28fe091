"""Check-in and loan reports on the small library."""

import datetime as dt

import pytest

from shelfmark import plans
from small_library import tables

D = dt.date


@pytest.fixture(scope="module")
def library(spark):
    return tables(spark)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_course_stats_count_whole_days(library):
    df = plans.circ_stats_course_reserves(library, "INTRO", "2024-01-01", "2024-01-01")
    assert rows(df) == [(None, "Greek", 1), ("B1", "Latin", 1)]
    assert df.dtypes == list(plans.circulation.CIRC_STATS_SCHEMA)


def test_course_stats_leave_out_unlent_items(library):
    df = plans.circ_stats_course_reserves(library, "intro", "2024-01-02", "2024-02-01")
    assert rows(df) == [("B1", "Latin", 1)]


def test_course_stats_show_lent_items_without_a_record(library):
    df = plans.circ_stats_course_reserves(library, "^torts$")
    assert rows(df) == [(None, None, 1)]


def test_course_stats_without_a_pattern(library):
    assert rows(plans.circ_stats_course_reserves(library, None)) == []


def test_history_ends_at_midnight(library):
    df = plans.circulation_history(library, "B1", "2024-01-01", "2024-01-31")
    assert sorted(rows(df)) == [("c1", D(2024, 1, 1)), ("c2", D(2024, 1, 31))]


def test_history_of_a_former_barcode(library):
    assert rows(plans.circulation_history(library, "OLD")) == []


def test_history_of_many_barcodes(spark, library):
    barcodes = spark.createDataFrame([("B1",), ("B2",), ("B2",), ("?",), (None,)], "barcode string")
    df = plans.circulation_history(library, barcodes, "2024-01-04", "2024-01-31")
    assert sorted(rows(df)) == [("c2", D(2024, 1, 31), "B1"), ("c5", D(2024, 1, 5), "B2")]


def test_internal_use_is_one_row(library):
    assert rows(plans.internal_use_count(library, "B1")) == [(1,)]
    df = plans.internal_use_count(library, "?")
    assert rows(df) == [(0,)]
    assert df.dtypes == [("internal_use_count", "int")]


def test_internal_use_of_all_items(spark, library):
    assert sorted(rows(plans.internal_use_by_item(library))) == [("B1", 1), ("B2", 0), ("B3", 0)]
    some = spark.createDataFrame([("B2",), ("?",)], "barcode string")
    assert rows(plans.internal_use_by_item(library, some)) == [("B2", 0)]


def test_zero_use_looks_inside_the_window_only(library):
    df = plans.zero_use_items(library, "2024-01-01", "2024-01-31", "loc1")
    assert sorted(rows(df)) == [("i3", "Greek"), ("i4", "Latin"), ("i4", "Latin, new")]
    later = plans.zero_use_items(library, "2024-02-01", "2024-02-28", "loc1")
    assert sorted(r[0] for r in rows(later)) == ["i1", "i1", "i2", "i3", "i4", "i4"]


def test_zero_use_in_the_default_location(library):
    assert rows(plans.zero_use_items(library)) == []
