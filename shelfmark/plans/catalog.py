"""The reports with their parameters, for callers that hold form input as text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from shelfmark.plans import circulation, derived, inventory, reserves
from shelfmark.sources import Tables

DATE, TEXT = "date", "text"


@dataclass(frozen=True)
class Parameter:
    name: str
    kind: str
    required: bool = False

    def read(self, value: object) -> str | None:
        """The value a report takes: ISO days for dates, None for a blank date."""
        if value is None:
            return None
        text = value.isoformat() if isinstance(value, dt.date) else str(value)
        if self.kind == TEXT:
            return text
        if text.strip() == "":
            return None
        try:
            return dt.date.fromisoformat(text.strip()).isoformat()
        except ValueError as error:
            raise ValueError(f"{self.name}: {text!r} is not a date (yyyy-mm-dd)") from error


@dataclass(frozen=True)
class ReportSpec:
    """A report function and the parameters a form may fill in."""

    build: Callable[..., DataFrame]
    parameters: tuple[Parameter, ...] = ()

    def bind(self, values: Mapping[str, object]) -> dict[str, str]:
        """Checked keyword arguments; values left out take the function's defaults."""
        known = {p.name.lower(): p for p in self.parameters}
        given = {name.lower(): value for name, value in values.items()}
        unknown = sorted(set(given) - set(known))
        if unknown:
            raise ValueError(f"unknown parameter: {', '.join(unknown)}")
        bound = {n: p.read(given.get(n)) for n, p in known.items()}
        missing = [n for n, p in known.items() if p.required and bound[n] in (None, "")]
        if missing:
            raise ValueError(f"missing parameter: {', '.join(missing)}")
        return {n: v for n, v in bound.items() if v is not None}

    def run(self, tables: Tables, values: Mapping[str, object] | None = None) -> DataFrame:
        return self.build(tables, **self.bind(values or {}))


_START, _END = Parameter("start_date", DATE), Parameter("end_date", DATE)
_TERM = Parameter("term_name", TEXT)
_EXCLUSIONS = Parameter("exclusions", TEXT)
_HISTORICAL = Parameter("show_historical", TEXT)
_BARCODE = Parameter("barcode_to_check", TEXT, required=True)

# Report names, parameter names, types and which are required.
REPORTS: dict[str, ReportSpec] = {
    "reserves_permanent": ReportSpec(
        reserves.reserves_permanent,
        (_START, _END, _EXCLUSIONS, _HISTORICAL, Parameter("course_codes", TEXT)),
    ),
    "reserves_quarter": ReportSpec(
        reserves.reserves_quarter, (_TERM, _START, _END, _EXCLUSIONS, _HISTORICAL)
    ),
    "reserves_quarter_course": ReportSpec(
        reserves.reserves_quarter_course,
        (
            Parameter("course_codes", TEXT, required=True), _TERM, _START, _END, _EXCLUSIONS,
            _HISTORICAL,
        ),
    ),
    "reserves_listings_only": ReportSpec(
        reserves.reserves_listings_only,
        (
            _START, _END, _TERM, Parameter("course_codes", TEXT), _EXCLUSIONS,
            Parameter("show_historical_reserves", TEXT),
            Parameter("show_historical_checkouts", TEXT),
        ),
    ),
    "circ_stats_course_reserves": ReportSpec(
        circulation.circ_stats_course_reserves,
        (Parameter("circ_stat_course_name", TEXT, required=True), _START, _END),
    ),
    "class_list": ReportSpec(inventory.class_list, (Parameter("note_string", TEXT),)),
    "circulation_history": ReportSpec(
        circulation.circulation_history, (_BARCODE, _START, _END)
    ),
    "internal_use_count": ReportSpec(circulation.internal_use_count, (_BARCODE,)),
    "collection_inventory": ReportSpec(
        inventory.collection_inventory,
        (
            Parameter("i_call_number_prefix", TEXT, required=True),
            Parameter("call_number_label", TEXT), Parameter("link_base", TEXT),
        ),
    ),
    "note_type_items": ReportSpec(
        inventory.note_type_items, (Parameter("note_type_id", TEXT),)
    ),
    "instance_ext": ReportSpec(derived.instance_ext),
    "item_ext": ReportSpec(derived.item_ext),
    "item_circulation_notes": ReportSpec(derived.item_circulation_notes),
    "zero_use_items": ReportSpec(
        circulation.zero_use_items, (_START, _END, Parameter("location_id", TEXT))
    ),
}


def run_report(
    name: str, tables: Tables, values: Mapping[str, object] | None = None
) -> DataFrame:
    """Run a report by name with form values, e.g. ``{"term_name": "2025 Fall Quarter"}``."""
    if name not in REPORTS:
        raise KeyError(f"no report {name!r}; there are {', '.join(sorted(REPORTS))}")
    return REPORTS[name].run(tables, values)
