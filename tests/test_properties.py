"""Shared operators against straightforward Python on random small data."""

import datetime as dt
import random
from collections import Counter

import pytest

from shelfmark.operators import (
    Window, count_checkouts, count_checkouts_per_window, date_literal, resolve_terms,
)
from shelfmark import plans
from small_library import tables

DAY = dt.date(2024, 1, 1)


def random_courses(seed):
    rng = random.Random(seed)
    dates = [None, DAY, DAY + dt.timedelta(1), DAY + dt.timedelta(2)]
    terms = [
        (f"t{i}", rng.choice(["A", "B", "Permanent"]), rng.choice(dates), rng.choice(dates))
        for i in range(8)
    ]
    listings = [(f"L{i}", rng.choice([None, "t-gone"] + [t[0] for t in terms])) for i in range(12)]
    listings += [(rng.choice(listings)[0], rng.choice(terms)[0]) for _ in range(3)]  # versions
    courses = [
        (f"L{rng.randrange(14)}", rng.choice([None, "", "N1", "N1", "N1", "N2", "N3"]))
        for _ in range(30)
    ]
    return courses, listings, terms


def best_term(course, courses, listings, terms, allowed, preferred):
    """The first candidate in order, trying every course, listing and term."""
    listing, number = course
    found = [
        (
            own != listing, preferred is None or name != preferred, start is not None,
            -start.toordinal() if start else 0, name, term, start, end,
        )
        for peer, peer_number in courses if peer_number == number and number is not None
        for own, own_term in listings if own == peer
        for term, name, start, end in terms
        if term == own_term and (allowed is None or name in allowed)
    ]
    if not found:
        return None, None, None
    first = min(found, key=lambda f: f[:6])
    return first[4], first[6], first[7]


@pytest.mark.parametrize("seed, allowed, preferred", [
    (1, None, None), (2, None, "A"), (3, ["A", "Permanent"], "A"), (4, ["B"], None),
    (5, ["none"], "none"), (6, None, "B"),
])
def test_terms_are_the_best_of_all_candidates(spark, seed, allowed, preferred):
    courses, listings, terms = random_courses(seed)
    resolved = resolve_terms(
        spark.createDataFrame(courses, "course_listing_id string, course_number string"),
        spark.createDataFrame(listings, "id string, term_id string"),
        spark.createDataFrame(terms, "id string, name string, start_date date, end_date date"),
        allowed, preferred,
    )
    versions = Counter(courses)
    assert {tuple(r) for r in resolved.collect()} == {
        (*c, versions[c], *best_term(c, courses, listings, terms, allowed, preferred))
        for c in versions
    }


def random_loans(seed):
    rng = random.Random(seed)
    midnight = dt.datetime(2024, 1, 1)
    return [
        (
            n, f"i{rng.randrange(4)}", rng.choice(["checkedout", "checkedout", "checkedin"]),
            midnight + dt.timedelta(days=rng.randrange(8), seconds=rng.choice([0, 0, 1, 40000])),
        )
        for n in range(120)
    ]


def inside(moment, start, end):
    def at(day):
        return dt.datetime.combine(day, dt.time())

    return at(start) <= moment <= at(end)


LOANS = "__id bigint, item_id string, action string, loan_date timestamp"


@pytest.mark.parametrize("seed", [1, 2])
def test_window_counts_equal_counting_loan_by_loan(spark, seed):
    loans = random_loans(seed)
    days = [DAY + dt.timedelta(n) for n in range(8)]
    wanted = [(s, e) for s in days for e in days] * 2
    counted = count_checkouts_per_window(
        spark.createDataFrame(loans, LOANS),
        spark.createDataFrame([*wanted, (None, DAY)], "window_start date, window_end date"),
    )
    want = Counter()
    for start, end in set(wanted):
        for _, lent, action, moment in loans:
            if action == "checkedout" and inside(moment, start, end):
                want[lent, start, end] += 1
    got = {(r.item_id, r.window_start, r.window_end): r.checkouts for r in counted.collect()}
    assert got == dict(want)


def test_fixed_window_equals_the_same_window_per_row(spark):
    loans = spark.createDataFrame(random_loans(3), LOANS)
    window = Window(date_literal("2024-01-02"), date_literal("2024-01-05"))
    windows = loans.selectExpr(
        "date'2024-01-02' as window_start", "date'2024-01-05' as window_end"
    )
    fixed = {r.item_id: r.checkouts for r in count_checkouts(loans, window).collect()}
    per_row = count_checkouts_per_window(loans, windows).collect()
    assert fixed == {r.item_id: r.checkouts for r in per_row}


def test_history_holds_all_current_rows(spark):
    library = tables(spark)
    current = {tuple(r) for r in plans.reserves_quarter_course(library).collect()}
    history = {tuple(r) for r in plans.reserves_quarter_course(library, show_historical="1").collect()}
    assert current <= history


def test_exclusions_only_remove_rows(spark):
    library = tables(spark)
    everything = {tuple(r) for r in plans.reserves_quarter(library).collect()}
    for flags in ("POP", "LAW", "NEW", "EMPTY", "POP,LAW,NEW,EMPTY"):
        kept = {tuple(r) for r in plans.reserves_quarter(library, exclusions=flags).collect()}
        assert kept <= everything
