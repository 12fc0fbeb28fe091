from shelfmark.operators.courses import (
    count_versions, current_only, exclude_courses, is_on, match_course_codes,
)
from shelfmark.operators.joins import keep_keys, lookup_names, skew_join
from shelfmark.operators.loans import (
    count_checkouts, count_checkouts_per_window, count_loans, never_checked_in,
)
from shelfmark.operators.records import (
    explode_notes, item_facts, item_notes, known_instances, known_items, wide_instances,
    wide_items, with_titles,
)
from shelfmark.operators.result import conform, ordered
from shelfmark.operators.terms import PERMANENT, Window, date_literal, resolve_terms, term_window

__all__ = [
    "PERMANENT", "Window", "conform", "count_checkouts", "count_checkouts_per_window",
    "count_loans", "count_versions", "current_only", "date_literal", "exclude_courses",
    "explode_notes", "is_on", "item_facts", "item_notes", "keep_keys", "known_instances",
    "known_items", "lookup_names", "match_course_codes", "never_checked_in", "ordered",
    "resolve_terms", "skew_join", "term_window", "wide_instances", "wide_items", "with_titles",
]
