"""Wide item and instance rows from raw records, and note rows from their arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions import (
    Elements, as_boolean, as_timestamp, as_uuid, explode_elements, with_document_fields,
)
from shelfmark.operators.courses import count_versions
from shelfmark.operators.joins import keep_keys, lookup_names, skew_join
from shelfmark.operators.result import conform
from shelfmark.sources import Tables

# Result columns and types of the wide item table.
ITEM_SCHEMA = (
    ("item_id", "string"),
    ("item_hrid", "string"),
    ("accession_number", "string"),
    ("barcode", "string"),
    ("chronology", "string"),
    ("copy_number", "string"),
    ("enumeration", "string"),
    ("volume", "string"),
    ("in_transit_destination_service_point_id", "string"),
    ("in_transit_destination_service_point_name", "string"),
    ("identifier", "string"),
    ("call_number", "string"),
    ("call_number_type_id", "string"),
    ("call_number_type_name", "string"),
    ("effective_call_number_prefix", "string"),
    ("effective_call_number", "string"),
    ("effective_call_number_suffix", "string"),
    ("effective_call_number_type_id", "string"),
    ("effective_call_number_type_name", "string"),
    ("damaged_status_id", "string"),
    ("damaged_status_name", "string"),
    ("material_type_id", "string"),
    ("material_type_name", "string"),
    ("number_of_pieces", "string"),
    ("number_of_missing_pieces", "string"),
    ("permanent_loan_type_id", "string"),
    ("permanent_loan_type_name", "string"),
    ("temporary_loan_type_id", "string"),
    ("temporary_loan_type_name", "string"),
    ("permanent_location_id", "string"),
    ("permanent_location_name", "string"),
    ("temporary_location_id", "string"),
    ("temporary_location_name", "string"),
    ("effective_location_id", "string"),
    ("effective_location_name", "string"),
    ("description_of_pieces", "string"),
    ("status_date", "string"),
    ("status_name", "string"),
    ("holdings_record_id", "string"),
    ("discovery_suppress", "boolean"),
    ("created_date", "timestamp_ntz"),
    ("updated_by_user_id", "string"),
    ("updated_date", "string"),
)

# Result column -> key column of the raw item record.
ITEM_KEYS = {
    "item_id": "id",
    "material_type_id": "materialtypeid",
    "permanent_loan_type_id": "permanentloantypeid",
    "temporary_loan_type_id": "temporaryloantypeid",
    "permanent_location_id": "permanentlocationid",
    "temporary_location_id": "temporarylocationid",
    "effective_location_id": "effectivelocationid",
    "holdings_record_id": "holdingsrecordid",
    "created_date": "creation_date",
}

# Result column -> column of the flat item table.
ITEM_FLAT = {"item_hrid": "hrid", "barcode": "barcode", "enumeration": "enumeration"}

# Result column -> path in the item document.
ITEM_PATHS = {
    "accession_number": "accessionNumber",
    "chronology": "chronology",
    "copy_number": "copyNumber",
    "volume": "volume",
    "in_transit_destination_service_point_id": "inTransitDestinationServicePointId",
    "identifier": "itemIdentifier",
    "call_number": "itemLevelCallNumber",
    "call_number_type_id": "itemLevelCallNumberTypeId",
    "effective_call_number_prefix": "effectiveCallNumberComponents.prefix",
    "effective_call_number": "effectiveCallNumberComponents.callNumber",
    "effective_call_number_suffix": "effectiveCallNumberComponents.suffix",
    "effective_call_number_type_id": "effectiveCallNumberComponents.typeId",
    "damaged_status_id": "itemDamagedStatusId",
    "number_of_pieces": "numberOfPieces",
    "number_of_missing_pieces": "numberOfMissingPieces",
    "description_of_pieces": "descriptionOfPieces",
    "status_date": "status.date",
    "status_name": "status.name",
    "discovery_suppress": "discoverySuppress",
    "updated_by_user_id": "metadata.updatedByUserId",
    "updated_date": "metadata.updatedDate",
}

# Name column -> (lookup table, key column).
ITEM_NAMES = {
    "in_transit_destination_service_point_name":
        ("service_points", "in_transit_destination_service_point_id"),
    "call_number_type_name": ("call_number_types", "call_number_type_id"),
    "effective_call_number_type_name": ("call_number_types", "effective_call_number_type_id"),
    "damaged_status_name": ("item_damaged_statuses", "damaged_status_id"),
    "material_type_name": ("material_types", "material_type_id"),
    "permanent_loan_type_name": ("loan_types", "permanent_loan_type_id"),
    "temporary_loan_type_name": ("loan_types", "temporary_loan_type_id"),
    "permanent_location_name": ("locations", "permanent_location_id"),
    "temporary_location_name": ("locations", "temporary_location_id"),
    "effective_location_name": ("locations", "effective_location_id"),
}

# Result columns and types of the wide instance table.
INSTANCE_SCHEMA = (
    ("instance_id", "string"),
    ("instance_hrid", "string"),
    ("cataloged_date", "date"),
    ("title", "string"),
    ("index_title", "string"),
    ("type_id", "string"),
    ("type_name", "string"),
    ("mode_of_issuance_id", "string"),
    ("mode_of_issuance_name", "string"),
    ("previously_held", "boolean"),
    ("instance_source", "string"),
    ("discovery_suppress", "boolean"),
    ("staff_suppress", "boolean"),
    ("status_id", "string"),
    ("status_name", "string"),
    ("status_updated_date", "timestamp"),
    ("record_source", "string"),
    ("record_created_date", "timestamp"),
    ("updated_by_user_id", "string"),
    ("updated_date", "timestamp_ntz"),
    ("match_key", "string"),
    ("is_bound_with", "boolean"),
)

# Result column -> column of the flat instance table.
INSTANCE_FLAT = {
    "instance_id": "id",
    "instance_hrid": "hrid",
    "cataloged_date": "cataloged_date",
    "title": "title",
    "index_title": "index_title",
    "type_id": "instance_type_id",
    "mode_of_issuance_id": "mode_of_issuance_id",
    "previously_held": "previously_held",
    "instance_source": "source",
    "discovery_suppress": "discovery_suppress",
    "staff_suppress": "staff_suppress",
    "status_id": "status_id",
    "status_updated_date": "status_updated_date",
    "record_source": "source",
}

# Result column -> path in the instance document.
INSTANCE_PATHS = {
    "record_created_date": "metadata.createdDate",
    "updated_by_user_id": "metadata.updatedByUserId",
    "updated_date": "metadata.updatedDate",
    "match_key": "matchKey",
    "is_bound_with": "isBoundWith",
}

# Name column -> (lookup table, key column).
INSTANCE_NAMES = {
    "type_name": ("instance_types", "type_id"),
    "mode_of_issuance_name": ("modes_of_issuance", "mode_of_issuance_id"),
    "status_name": ("instance_statuses", "status_id"),
}

FALSE_BY_DEFAULT = ("previously_held", "discovery_suppress", "staff_suppress", "is_bound_with")


def wide_items(
    tables: Tables, columns: Sequence[str] | None = None, only: DataFrame | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Item rows with document fields and lookup names; ``columns`` cuts the work.

    Only the wanted columns' sources are touched: the flat table is joined, the document
    parsed and a lookup joined only if some wanted column comes from there. ``only`` may
    name the items that matter; the others go no further than the join with the flat
    table, which is by the same key. ``carried`` names columns that the raw records have in
    addition, to be passed through.
    """
    columns = list(columns or [name for name, _ in ITEM_SCHEMA])
    named = {c: ITEM_NAMES[c] for c in columns if c in ITEM_NAMES}
    needed = dict.fromkeys([*columns, "item_id", *(key for _, key in named.values())])
    paths = {c: ITEM_PATHS[c] for c in needed if c in ITEM_PATHS}
    flat = {c: ITEM_FLAT[c] for c in needed if c in ITEM_FLAT}
    keys = [c for c in needed if c in ITEM_KEYS]

    items = tables["item_records"].select(
        *(F.col(ITEM_KEYS[c]).alias(c) for c in keys), *carried, *(["jsonb"] if paths else [])
    )
    if paths:
        fields = with_document_fields(items, "jsonb", paths, [*keys, *carried])
        items = _typed(fields, ITEM_SCHEMA, paths)
    if flat:
        table = tables["items"].select(
            F.col("id").alias("item_id"), *(F.col(s).alias(c) for c, s in flat.items())
        )
        items = items.join(table, "item_id", "left")
    items = keep_keys(items, only)
    items = lookup_names(items, [(tables[t], key, name) for name, (t, key) in named.items()])
    types = {**dict(items.dtypes), **dict(ITEM_SCHEMA)}
    columns = [*columns, *carried]
    return conform(items.select(*columns), [(c, types[c]) for c in columns])


def known_items(
    tables: Tables, columns: Sequence[str], only: DataFrame | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """``wide_items``, taken from a registered ``item_ext`` if there is one."""
    if "item_ext" in tables:
        return keep_keys(_registered(tables, "item_ext", [*columns, *carried]), only)
    return wide_items(tables, columns, only, carried)


def known_instances(tables: Tables, columns: Sequence[str]) -> DataFrame:
    """``wide_instances``, taken from a registered ``instance_ext`` if there is one."""
    if "instance_ext" in tables:
        return _registered(tables, "instance_ext", columns)
    return wide_instances(tables, columns)


def _registered(tables: Tables, name: str, columns: Sequence[str]) -> DataFrame:
    table = tables[name]
    missing = [c for c in columns if c not in table.columns]
    if missing:
        raise ValueError(f"this needs the columns {', '.join(missing)} in table {name!r}")
    return table.select(*columns)


def wide_instances(tables: Tables, columns: Sequence[str] | None = None) -> DataFrame:
    """Instance rows with document fields and lookup names; ``columns`` cuts the work."""
    columns = list(columns or [name for name, _ in INSTANCE_SCHEMA])
    named = {c: INSTANCE_NAMES[c] for c in columns if c in INSTANCE_NAMES}
    needed = dict.fromkeys([*columns, "instance_id", *(key for _, key in named.values())])
    paths = {c: INSTANCE_PATHS[c] for c in needed if c in INSTANCE_PATHS}

    instances = tables["instances"].select(
        *(F.col(INSTANCE_FLAT[c]).alias(c) for c in needed if c in INSTANCE_FLAT)
    )
    if paths:
        documents = tables["instance_records"].select(F.col("id").alias("instance_id"), "jsonb")
        fields = with_document_fields(documents, "jsonb", paths, ["instance_id"])
        instances = instances.join(
            _typed(fields, INSTANCE_SCHEMA, paths), "instance_id", "left"
        )
    instances = lookup_names(
        instances, [(tables[t], key, name) for name, (t, key) in named.items()]
    )
    types = dict(INSTANCE_SCHEMA)
    wide = instances.select(*(
        F.coalesce(F.col(c), F.lit(False)).alias(c) if c in FALSE_BY_DEFAULT else F.col(c)
        for c in columns
    ))
    return conform(wide, [(c, types[c]) for c in columns])


def _typed(df: DataFrame, schema: Sequence[tuple[str, str]], paths: dict[str, str]) -> DataFrame:
    """Give document texts their types: booleans and times parsed, ids in lower case."""
    types = dict(schema)

    def typed(name: str) -> Column:
        if name not in paths:
            return F.col(name)
        if types[name] == "boolean":
            return as_boolean(F.col(name)).alias(name)
        if types[name].startswith("timestamp"):
            return as_timestamp(F.col(name)).alias(name)
        if name.endswith("_id") or name == "match_key":
            return as_uuid(F.col(name)).alias(name)
        return F.col(name)

    return df.select(*(typed(c) for c in df.columns))


def explode_notes(
    records: DataFrame, path: str, fields: Sequence[str], keys: Sequence[str],
    paths: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per element of a document array: ``keys``, further document ``paths``, the
    element's ``fields`` and its 1-based ``ordinality``."""
    read = {**(paths or {}), "_elements": Elements(path, tuple(fields))}
    return explode_elements(
        with_document_fields(records, "jsonb", read, keys), "_elements", fields
    )


def item_notes(tables: Tables) -> DataFrame:
    """``item_id, note`` for each element of the items' notes."""
    if "item_notes" in tables:
        return tables["item_notes"].select("item_id", "note")
    notes = explode_notes(tables["item_records"], "notes", ["note"], ["id"])
    return notes.select(F.col("id").alias("item_id"), "note")


def with_titles(tables: Tables, items: DataFrame) -> DataFrame:
    """Add ``instance_title`` by way of the holdings; items may lack either."""
    holdings = tables["holdings_ext"].select(
        F.col("holdings_id").alias("holdings_record_id"), "instance_id"
    )
    titles = known_instances(tables, ["instance_id", "title"]).select(
        "instance_id", F.col("title").alias("instance_title")
    )
    return items.join(holdings, "holdings_record_id", "left").join(titles, "instance_id", "left")


def holdings_titles(tables: Tables) -> DataFrame:
    """``holdings_record_id, instance_title`` once each, with the number of rows behind them."""
    holdings = tables["holdings_ext"].select(
        F.col("holdings_id").alias("holdings_record_id"), "instance_id"
    )
    titles = known_instances(tables, ["instance_id", "title"]).select(
        "instance_id", F.col("title").alias("instance_title")
    )
    return count_versions(
        holdings.join(titles, "instance_id", "left"), ["holdings_record_id", "instance_title"],
        "title_versions",
    )


def item_facts(
    tables: Tables, only: DataFrame | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """``item_id, item_barcode, call_number, instance_title`` once each, with the number of
    rows behind them and, given ``counts`` per item, their columns.

    Records, flat items, wanted items and counts all meet on the item, where copies of a
    record are combined too; only the combined rows go on to the titles.
    """
    items = known_items(
        tables, ["item_id", "barcode", "effective_call_number", "holdings_record_id"], only
    ).select(
        "item_id", "holdings_record_id", F.col("barcode").alias("item_barcode"),
        F.col("effective_call_number").alias("call_number"),
    )
    facts = ["item_id", "item_barcode", "call_number"]
    items = count_versions(items, [*facts, "holdings_record_id"], "copies")
    counted: list[str] = []
    if counts is not None:
        items = items.join(counts, "item_id", "left")
        counted = [c for c in counts.columns if c != "item_id"]
    titled = skew_join(items, holdings_titles(tables), ["holdings_record_id"])
    versions = F.col("copies") * F.coalesce("title_versions", F.lit(1))
    return titled.groupBy(*facts, "instance_title", *counted).agg(
        F.sum(versions).alias("item_versions")
    )
