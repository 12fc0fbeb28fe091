"""Course-reserve reports on the small library; expected rows worked out by hand."""

import datetime as dt

import pytest

from shelfmark import plans
from small_library import tables

D = dt.date


@pytest.fixture(scope="module")
def library(spark):
    return tables(spark)


def by_listing(df, *extra):
    return sorted(
        (
            (r.course_listing_id, r.item_id, r.course_term, r.checkout_count, *(r[e] for e in extra))
            for r in df.collect()
        ),
        key=str,
    )


class TestQuarter:
    def test_all_courses_and_dates(self, library):
        assert by_listing(plans.reserves_quarter(library)) == [
            ("l1", "i1", "Winter", 8),  # two versions of the course, four loans
            ("l2", "i1", "Spring", 4),
            ("l3", "i2", "Permanent", 1),
            ("l4", "i2", "Spring", 1),  # the latest start among the peers' terms
            ("l5", "i3", None, 0),
            ("l6", "i1", None, 4),  # no number, hence no term
            ("l7", "i9", None, 0),  # loans of an item without a record do not count
        ]

    def test_named_term_sets_the_dates_and_drops_other_courses(self, library):
        assert by_listing(plans.reserves_quarter(library, term_name="Winter")) == [
            ("l1", "i1", "Winter", 4),  # the loan after midnight of the last day is out
            ("l2", "i1", "Winter", 2),
            ("l3", "i2", "Permanent", 1),
            ("l4", "i2", "Winter", 1),
        ]

    def test_of_two_terms_with_a_name_the_earlier_sets_the_dates(self, library):
        rows = by_listing(plans.reserves_quarter(library, term_name="Spring"))
        assert rows == [
            ("l1", "i1", "Spring", 0), ("l2", "i1", "Spring", 0), ("l3", "i2", "Permanent", 0),
            ("l4", "i2", "Spring", 0),
        ]

    def test_unknown_term_leaves_permanent_courses_uncounted(self, library):
        rows = by_listing(plans.reserves_quarter(library, term_name="Nope"))
        assert rows == [("l3", "i2", "Permanent", 0)]

    def test_term_of_spaces_is_blank_for_dates_but_not_for_courses(self, library):
        rows = by_listing(plans.reserves_quarter(library, term_name="  "))
        assert rows == [("l3", "i2", "Permanent", 1)]

    def test_dates_end_at_midnight(self, library):
        df = plans.reserves_quarter(library, start_date="2024-01-01", end_date="2024-01-01")
        assert [r for r in by_listing(df) if r[3]] == [("l1", "i1", "Winter", 2), ("l2", "i1", "Spring", 1), ("l6", "i1", None, 1)]

    def test_versions_of_a_reserve_merge_and_add_up(self, library):
        rows = by_listing(plans.reserves_quarter(library, show_historical="YES "))
        assert rows[0] == ("l1", "i1", "Winter", 16)
        assert ("l3", "i2", "Permanent", 2) in rows

    @pytest.mark.parametrize("flags, gone", [
        ("law", {"l6", "l7"}), ("EMPTY", {"l6"}), ("POP, NEW", set()), ("", set()), (None, set()),
    ])
    def test_exclusions(self, library, flags, gone):
        df = plans.reserves_quarter(library, exclusions=flags)
        assert {"l1", "l2", "l3", "l4", "l5", "l6", "l7"} - {r[0] for r in by_listing(df)} == gone

    def test_order_and_columns(self, library):
        df = plans.reserves_quarter(library)
        terms = [r.course_term for r in df.collect()]
        assert terms == ["Permanent", "Spring", "Spring", "Winter", None, None, None]
        assert df.dtypes == list(plans.reserves.QUARTER_SCHEMA)

    def test_current_versions_count_once(self, library):
        rows = by_listing(plans.reserves_quarter(library.current_versions()))
        assert rows[0] == ("l1", "i1", "Winter", 4)


class TestPermanent:
    COLUMNS = ("is_current", "reserves_start_date", "reserves_end_date")

    def test_current_reserves(self, library):
        df = plans.reserves_permanent(library)
        assert by_listing(df, *self.COLUMNS) == [("l3", "i2", "Permanent", 1, 1, None, None)]
        assert df.dtypes == list(plans.reserves.DATED_SCHEMA)

    def test_history_keeps_versions_apart(self, library):
        df = plans.reserves_permanent(library, show_historical="1")
        assert by_listing(df, *self.COLUMNS) == [
            ("l3", "i2", "Permanent", 1, 0, None, D(2030, 1, 1)),
            ("l3", "i2", "Permanent", 1, 1, None, None),
        ]

    @pytest.mark.parametrize("codes, found", [
        ("cs102", 1), (" CS 102 , x", 1), ("cs101", 0), ("", 1), (None, 1), ("  ", 0), ("x,", 0),
    ])
    def test_codes(self, library, codes, found):
        assert plans.reserves_permanent(library, course_codes=codes).count() == found

    def test_codes_as_a_table(self, spark, library):
        codes = spark.createDataFrame([("cs102",), ("zz9",)], "course_code string")
        assert plans.reserves_permanent(library, course_codes=codes).count() == 1

    def test_checkout_dates(self, library):
        df = plans.reserves_permanent(library, "2024-03-01", "2024-12-31")
        assert by_listing(df) == [("l3", "i2", "Permanent", 0)]


class TestQuarterCourse:
    def test_each_row_counts_within_its_own_term(self, library):
        df = plans.reserves_quarter_course(library, "cs101", show_historical="on")
        assert by_listing(df, "is_current") == [
            ("l1", "i1", "Winter", 4, 0), ("l1", "i1", "Winter", 4, 1),
            ("l2", "i1", "Spring", 1, 1), ("l4", "i2", "Spring", 0, 1),
        ]

    def test_undated_term_takes_the_named_terms_dates(self, library):
        df = plans.reserves_quarter_course(library, "CS 102", term_name="Winter")
        assert by_listing(df) == [("l3", "i2", "Permanent", 1)]

    def test_undated_term_takes_the_given_dates(self, library):
        inside = plans.reserves_quarter_course(library, "CS 102", None, "2024-02-01", "2024-02-02")
        outside = plans.reserves_quarter_course(library, "CS 102", None, "2024-02-02", "2024-02-03")
        assert by_listing(inside) == [("l3", "i2", "Permanent", 1)]
        assert by_listing(outside) == [("l3", "i2", "Permanent", 0)]

    def test_own_dates_beat_given_dates(self, library):
        df = plans.reserves_quarter_course(library, "CS 101", None, "1990-01-01", "1990-01-02")
        assert by_listing(df)[0] == ("l1", "i1", "Winter", 4)

    def test_unknown_term_counts_nothing(self, library):
        df = plans.reserves_quarter_course(library, "CS 102", term_name="Nope")
        assert by_listing(df) == [("l3", "i2", "Permanent", 0)]

    def test_history_lifts_the_term_filter(self, library):
        df = plans.reserves_quarter_course(library, "CS 101", "Winter", show_historical="t")
        assert {r[2] for r in by_listing(df)} == {"Winter", "Spring"}


class TestListingsOnly:
    def test_undated_reserves_count_loans_of_all_times(self, library):
        df = plans.reserves_listings_only(library, "2024-01-01", "2024-01-02")
        assert by_listing(df) == [
            ("l2", "i1", "Spring", 4), ("l3", "i2", "Permanent", 2), ("l4", "i2", "Spring", 2),
            ("l5", "i3", None, 0), ("l6", "i1", None, 4), ("l7", "i9", None, 0),
        ]

    def test_named_term_admits_no_permanent_courses(self, library):
        df = plans.reserves_listings_only(library, term_name="Winter")
        assert by_listing(df) == [("l2", "i1", "Winter", 4), ("l4", "i2", "Winter", 2)]

    def test_codes_lift_term_and_current_filters(self, library):
        df = plans.reserves_listings_only(library, term_name="Winter", course_codes="cs102")
        assert by_listing(df, "is_current") == [
            ("l3", "i2", "Permanent", 2, 0), ("l3", "i2", "Permanent", 2, 1),
        ]

    def test_code_list_of_spaces_matches_nothing(self, library):
        assert plans.reserves_listings_only(library, course_codes="  ").count() == 0

    def test_history_of_reserves_and_of_checkouts_are_apart(self, library):
        hidden = plans.reserves_listings_only(library, show_historical_reserves="1")
        shown = plans.reserves_listings_only(
            library, show_historical_reserves="1", show_historical_checkouts="1"
        )
        assert ("l3", "i2", "Permanent", 0, 0) in by_listing(hidden, "is_current")
        assert ("l3", "i2", "Permanent", 2, 0) in by_listing(shown, "is_current")

    def test_law_flag_keeps_unnumbered_courses(self, library):
        df = plans.reserves_listings_only(library, exclusions="LAW")
        assert {r[0] for r in by_listing(df)} == {"l2", "l3", "l4", "l5", "l6"}


def test_unsorted_has_the_same_rows(library):
    for report in (
        plans.reserves_permanent, plans.reserves_quarter, plans.reserves_quarter_course,
        plans.reserves_listings_only,
    ):
        assert by_listing(report(library, sort=False)) == by_listing(report(library))
