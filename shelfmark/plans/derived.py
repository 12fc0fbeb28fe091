"""Reports that flatten raw records into wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.functions import as_boolean, as_uuid
from shelfmark.operators import conform, explode_notes, wide_instances, wide_items
from shelfmark.sources import Tables

# Result columns and types.
CIRCULATION_NOTES_SCHEMA = (
    ("item_id", "string"), ("note_id", "string"), ("note", "string"), ("note_type", "string"),
    ("staff_only", "boolean"), ("ordinality", "bigint"),
)


def instance_ext(tables: Tables) -> DataFrame:
    """Instances with document fields and the names behind their ids."""
    return wide_instances(tables)


def item_ext(tables: Tables) -> DataFrame:
    """Items with document fields and the names behind their ids."""
    return wide_items(tables)


def item_circulation_notes(tables: Tables) -> DataFrame:
    """One row per circulation note of an item."""
    notes = explode_notes(
        tables["item_records"].select(F.col("id").alias("item_id"), "jsonb"),
        "circulationNotes", ["id", "note", "noteType", "staffOnly"], ["item_id"],
    )
    rows = notes.select(
        "item_id", as_uuid(F.col("id")), "note", "noteType", as_boolean(F.col("staffOnly")),
        "ordinality",
    )
    return conform(rows, CIRCULATION_NOTES_SCHEMA)
