"""Casts from document text to typed values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The spellings accepted for a boolean, any case, spaces around them ignored.
TRUE_WORDS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
FALSE_WORDS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")


def as_boolean(text: Column) -> Column:
    """Text to boolean, ``on`` and ``off`` included; NULL for anything else."""
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def as_uuid(text: Column) -> Column:
    """A document's id in the one form ids are compared in; NULL if it is malformed.

    Case, hyphens, braces and spaces around an id do not matter.
    """
    digits = F.regexp_replace(F.lower(F.trim(text)), "[{}-]", "")
    hyphened = F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(digits.rlike("^[0-9a-f]{32}$"), hyphened)


def as_timestamp(text: Column) -> Column:
    return text.cast("timestamp")


def within_midnights(moment: Column, start: Column, end: Column) -> Column:
    """``start 00:00 <= moment <= end 00:00``: later moments of the end day are outside."""
    return moment.between(start, end)


def within_days(moment: Column, start: Column, end: Column) -> Column:
    """Both days count as a whole. Bounds on the bare column can reach the file scan."""
    return (moment >= start) & (moment < F.date_add(end, 1))
