"""Reports that list items by note, note type or call number prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.functions import (
    Container, as_boolean, as_uuid, catalog_link, compose_call_number, concat_present, matches_regex,
)
from shelfmark.operators import (
    conform, explode_notes, item_notes, known_items, lookup_names, ordered, skew_join,
    wide_items, with_titles,
)
from shelfmark.sources import Tables

# The note type listed by default, the label before call numbers.
DEFAULT_NOTE_TYPE = "7a46e1ca-d2eb-49a3-9935-59bed639e6f1"
CALL_NUMBER_LABEL = "Curr "

# The catalogue's address is the caller's own; this default only shows its shape.
LINK_BASE = "https://catalog.example.org/Record/"

# Result columns and types.
CLASS_LIST_SCHEMA = (
    ("item_barcode", "string"), ("location_code", "string"), ("location_name", "string"),
    ("item_call_number", "string"), ("instance_title", "string"), ("item_note", "string"),
)
COLLECTION_SCHEMA = (
    ("location", "string"), ("index_title", "string"), ("contributor_name", "string"),
    ("call_number", "string"), ("volume", "string"), ("copy_number", "string"),
    ("link", "string"), ("item_barcode", "string"), ("item_id", "string"),
    ("holdings_id", "string"),
)
NOTE_TYPE_SCHEMA = (
    ("discovery_suppress", "string"), ("item_hrid", "string"), ("holdings_hrid", "string"),
    ("item_location", "string"), ("barcode", "string"), ("formerids", "string"),
    ("call_number", "string"), ("shelving_order", "string"), ("material_type", "string"),
    ("title", "string"), ("note_type_name", "string"), ("note", "string"),
    ("staff_only", "string"), ("note_ordinality", "int"),
)


def class_list(
    tables: Tables, note_string: str | None = None, fix_duplicate: bool = False, sort: bool = True
) -> DataFrame:
    """Items with a note that matches a pattern.

    The composed call number holds the effective call number twice and no suffix;
    ``fix_duplicate`` puts the suffix in the second place.
    """
    second = "effective_call_number_suffix" if fix_duplicate else "effective_call_number"
    parts = [
        "effective_call_number_prefix", "effective_call_number", second, "volume", "copy_number",
    ]
    columns = list(dict.fromkeys([
        "item_id", "barcode", "holdings_record_id", "effective_location_id",
        "effective_location_name", *parts,
    ]))
    wanted = matches_regex(F.col("note"), note_string)
    if "item_notes" in tables or "item_ext" in tables:
        notes = item_notes(tables).where(wanted)
        noted = skew_join(notes, known_items(tables, columns), ["item_id"], "inner")
    else:
        # Both come from the raw records: the matching notes are found first, row by row,
        # and only their items are read on and joined.
        records = tables["item_records"]
        notes = explode_notes(records, "notes", ["note"], records.columns).where(wanted)
        noted = wide_items(tables.with_tables(item_records=notes), columns, carried=["note"])
    codes = tables["locations_libraries"].select(
        F.col("location_id").alias("effective_location_id"), "location_code"
    )
    rows = (
        with_titles(tables, noted)
        .join(codes, "effective_location_id", "left")
        .select(
            "barcode", "location_code", "effective_location_name",
            compose_call_number(*(F.col(p) for p in parts)), "instance_title", "note",
        )
    )
    result = conform(rows, CLASS_LIST_SCHEMA).distinct()
    return ordered(result, ["location_name", "item_call_number"], sort)


def collection_inventory(
    tables: Tables,
    i_call_number_prefix: str,
    call_number_label: str = CALL_NUMBER_LABEL,
    link_base: str = LINK_BASE,
) -> DataFrame:
    """Items whose holdings carry a call number prefix, once per primary contributor."""
    holdings = tables["holdings"].where(
        F.col("call_number_prefix") == i_call_number_prefix
    ).select(F.col("id").alias("holdings_record_id"), "call_number", "instance_id")
    instances = tables["instances"].select(
        F.col("id").alias("instance_id"), "index_title", F.col("hrid").alias("instance_hrid")
    )
    # Distinct before the join as well as after it: copies would multiply the items.
    contributors = tables["instance_contributors"].where(
        F.col("contributor_is_primary")
    ).select("instance_id", "contributor_name").distinct()
    items = tables["items"].select(
        "id", "barcode", "volume", "copy_number", "holdings_record_id", "effective_location_id"
    )
    rows = (
        items.join(holdings, "holdings_record_id")
        .join(instances, "instance_id")
    )
    # Already by instance: a fresh shuffle lets a hot instance's items be split again.
    rows = skew_join(rows, contributors, ["instance_id"], "inner")
    rows = lookup_names(rows, [(tables["locations"], "effective_location_id", "location")])
    rows = rows.select(
        "location", "index_title", "contributor_name",
        concat_present(call_number_label, F.col("call_number")), "volume", "copy_number",
        catalog_link(F.col("instance_hrid"), link_base), "barcode", "id", "holdings_record_id",
    )
    return conform(rows, COLLECTION_SCHEMA).distinct()


def note_type_items(
    tables: Tables, note_type_id: str = DEFAULT_NOTE_TYPE, sort: bool = True
) -> DataFrame:
    """Every note of one type, with its item, holdings, instance and place."""
    paths = {
        "item_hrid": "hrid", "barcode": "barcode", "former_ids": Container("formerIds"),
        "shelving_order": "effectiveShelvingOrder",
    }
    notes = explode_notes(
        tables["item_records"], "notes", ["note", "staffOnly", "itemNoteTypeId"],
        ["holdingsrecordid", "effectivelocationid", "materialtypeid"], paths,
    ).withColumn("note_type", as_uuid(F.col("itemNoteTypeId")))
    wanted = note_type_id.strip().lower()
    notes = notes.where(F.col("note_type") == wanted)
    # All notes that are left share the one key. The type's row comes from a lookup table,
    # small enough for Spark to broadcast; else both sides are split by size.
    types = tables["item_note_types"].where(F.col("id") == wanted).select(
        F.col("id").alias("note_type"), F.col("name").alias("note_type_name")
    )
    holdings = tables["holdings"].select(
        F.col("id").alias("holdingsrecordid"), F.col("hrid").alias("holdings_hrid"),
        "call_number", "instance_id",
    )
    instances = tables["instances"].select(
        F.col("id").alias("instance_id"), "title", "discovery_suppress"
    )
    rows = (
        notes.join(types, "note_type")
        .join(holdings, "holdingsrecordid", "left")
        .join(instances, "instance_id", "left")
    )
    rows = lookup_names(rows, [
        (tables["locations"], "effectivelocationid", "item_location"),
        (tables["material_types"], "materialtypeid", "material_type"),
    ])
    rows = rows.select(
        "discovery_suppress", "item_hrid", "holdings_hrid", "item_location", "barcode",
        "former_ids", "call_number", "shelving_order", "material_type", "title",
        "note_type_name", "note", as_boolean(F.col("staffOnly")), "ordinality",
    )
    return ordered(
        conform(rows, NOTE_TYPE_SCHEMA), ["item_location", "shelving_order"], sort,
        spread_by=["item_hrid", "note_ordinality", "note"],
    )
