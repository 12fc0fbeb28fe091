"""Text expressions: course codes, call numbers, catalogue links."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from shelfmark.functions.patterns import java_pattern

# Fixed value: an upper-case letter directly followed by a digit.
LETTER_DIGIT = "([A-Z])([0-9])"


def normalise_code(code: Column) -> Column:
    """``cs101`` -> ``CS 101``: upper case, with a space between a letter and a digit."""
    return F.regexp_replace(F.upper(F.trim(code)), LETTER_DIGIT, "$1 $2")


def parse_code_list(codes: str) -> list[str]:
    """Normalise a comma-separated list the way ``normalise_code`` treats one code.

    A list of spaces only has no elements at all; a trailing comma does give an
    empty element, which then matches courses with an empty number.
    """
    text = re.sub(LETTER_DIGIT, r"\1 \2", codes.strip(" ").upper())
    text = re.sub(r"\s*,\s*", ",", text)
    return text.split(",") if text else []


def concat_present(*parts: Column | str) -> Column:
    """Concatenate, taking NULL parts as empty text; string arguments are literals."""
    return F.concat(*(
        F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit(""))
        for p in parts
    ))


def matches_regex(text: Column, pattern: str | None) -> Column:
    """Search for a pattern in the database's dialect, case-insensitive unless it begins with
    ``(?c)``; a NULL pattern matches nothing, and one that can't be read is a ``ValueError``."""
    if pattern is None:
        return F.lit(False)
    return text.rlike(java_pattern(pattern))


def compose_call_number(*parts: Column) -> Column:
    """The parts with one space between neighbours, NULLs as empty text, ends trimmed."""
    spaced: list[Column | str] = []
    for part in parts:
        spaced += [" ", part] if spaced else [part]
    return F.trim(concat_present(*spaced))


def catalog_link(hrid: Column, base: str) -> Column:
    """Catalogue address of a record; ids starting with ``b`` count to 8 characters."""
    short = F.when(hrid.startswith("b"), F.left(hrid, F.lit(8))).otherwise(hrid)
    return concat_present(base, short)
