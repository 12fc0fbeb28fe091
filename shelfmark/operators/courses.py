"""Filters on course numbers and reserve versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions import normalise_code, parse_code_list

# The spellings that switch a text toggle on.
ON_WORDS = ("1", "true", "t", "yes", "y", "on")

# Exclusion flags.
POP, LAW, NEW, EMPTY = "POP", "LAW", "NEW", "EMPTY"


def is_on(toggle: str | bool | None) -> bool:
    """A form toggle: text in any case, spaces around it ignored; NULL and blank are off."""
    if isinstance(toggle, bool):
        return toggle
    return (toggle or "").strip(" ").lower() in ON_WORDS


def current_only(df: DataFrame, show_historical: str | bool | None) -> DataFrame:
    """Keep rows flagged current, unless the toggle asks for all versions."""
    return df if is_on(show_historical) else df.where(F.col("__current"))


def match_course_codes(
    df: DataFrame, codes: str | DataFrame | None, column: str = "course_number"
) -> DataFrame:
    """Keep the listed course codes; NULL or empty text keeps everything.

    A code list too long for text is given as a DataFrame with a ``course_code`` column.
    """
    if isinstance(codes, DataFrame):
        wanted = codes.select(normalise_code(F.col("course_code")).alias("_code"))
        return df.join(wanted, normalise_code(F.col(column)) == F.col("_code"), "left_semi")
    if codes is None or codes == "":
        return df
    return df.where(normalise_code(F.col(column)).isin(parse_code_list(codes)))


def exclude_courses(
    df: DataFrame,
    exclusions: str | None,
    column: str = "course_number",
    law_keeps_unnumbered: bool = False,
) -> DataFrame:
    """Drop course kinds by flag; a flag counts wherever it occurs in the text.

    The LAW flag also drops NULL course numbers, for which the pattern test is unknown,
    unless ``law_keeps_unnumbered``.
    """
    flags = (exclusions or "").upper()
    number = F.col(column)
    if POP in flags:
        df = df.where(~number.eqNullSafe(POP))
    if LAW in flags:
        keep: Column = ~number.ilike("LAW%")
        if law_keeps_unnumbered:
            keep = number.isNull() | keep
        df = df.where(keep)
    if NEW in flags:
        df = df.where(~number.eqNullSafe(NEW))
    if EMPTY in flags:
        df = df.where(number.isNotNull() & (number != ""))
    return df


def count_versions(df: DataFrame, keys: Sequence[str], versions: str) -> DataFrame:
    """One row per distinct key, with the number of rows that shared it.

    Joining the condensed rows and multiplying the counts gives what counting the
    joined versions would, without producing them.
    """
    return df.groupBy(*keys).agg(F.count("*").alias(versions))
