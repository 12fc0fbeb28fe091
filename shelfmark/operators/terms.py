"""Which term a course belongs to, and which dates a term name stands for."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.operators.courses import count_versions
from shelfmark.operators.joins import skew_join

# Fixed value: the term of courses that run in every quarter.
PERMANENT = "Permanent"


@dataclass(frozen=True)
class Window:
    """Inclusive bounds; either bound may turn out NULL, and then nothing is inside."""

    start: Column
    end: Column


def date_literal(day: str) -> Column:
    return F.lit(day).cast("date")


def term_window(
    terms: DataFrame, term_name: str | None, start_date: str, end_date: str
) -> Window:
    """The dates of the named term, or the given dates when the name is blank.

    The term's dates are scalar subqueries: read once, on the cluster, and usable as
    scan filters. Of several terms with the name the earliest one counts; an unknown
    name gives NULL bounds.
    """
    if term_name is None or term_name.strip(" ") == "":
        return Window(date_literal(start_date), date_literal(end_date))
    start, end = F.col("start_date"), F.col("end_date")
    earliest = terms.where(F.col("name") == term_name).agg(
        F.min(F.struct(
            start.isNull().alias("a"), start, end.isNull().alias("b"), end, F.col("id")
        )).alias("term")
    )
    return Window(
        earliest.select("term.start_date").scalar(), earliest.select("term.end_date").scalar()
    )


def resolve_terms(
    courses: DataFrame,
    listings: DataFrame,
    terms: DataFrame,
    allowed: Sequence[str] | None = None,
    preferred: str | None = None,
) -> DataFrame:
    """The term of each distinct (listing, course number), and how often the pair occurs.

    A course takes the best term of its own listing or, failing that, the best term of
    any listing that carries the same course number. Best means: the preferred name,
    then no start date, then the latest start, then name and id. Only ``allowed`` term
    names take part. Courses without a number get no term.

    Every step is an aggregate that combines before it shuffles, so a course number or
    listing shared by a large part of the courses costs no more than any other.
    """
    pairs = count_versions(courses, ["course_listing_id", "course_number"], "course_versions")
    if allowed is not None:
        terms = terms.where(F.col("name").isin(list(allowed)))
    by_listing = (
        listings.select(F.col("id").alias("course_listing_id"), "term_id")
        .join(terms.select(F.col("id").alias("term_id"), *_ranked(preferred)), "term_id")
        .groupBy("course_listing_id")
        .agg(F.min("term").alias("own_term"))
    )
    by_number = (
        skew_join(
            courses.select("course_listing_id", "course_number"), by_listing,
            ["course_listing_id"], "inner",
        )
        .groupBy("course_number").agg(F.min("own_term").alias("shared_term"))
    )
    own = skew_join(pairs, by_listing, ["course_listing_id"]).withColumn(
        "own_term", F.when(F.col("course_number").isNotNull(), F.col("own_term"))
    )
    return (
        skew_join(own, by_number, ["course_number"])
        .withColumn("term", F.coalesce("own_term", "shared_term"))
        .select(
            "course_listing_id", "course_number", "course_versions",
            F.col("term.name").alias("course_term"),
            F.col("term.start_date").alias("term_start"),
            F.col("term.end_date").alias("term_end"),
        )
    )


def _ranked(preferred: str | None) -> list[Column]:
    """The term as a struct whose smallest value is the best term."""
    name, start = F.col("name"), F.col("start_date")
    missed = F.lit(1) if preferred is None else F.when(name == preferred, 0).otherwise(1)
    return [
        F.struct(
            missed.alias("missed"),
            start.isNotNull().alias("dated"),
            (-F.unix_date(start)).alias("latest"),
            name.isNull().alias("unnamed"),
            name.alias("name"),
            F.col("id").alias("id"),
            start.alias("start_date"),
            F.col("end_date").alias("end_date"),
        ).alias("term")
    ]
