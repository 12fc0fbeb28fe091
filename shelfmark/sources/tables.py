"""The registry that maps logical table names to DataFrames.

Reports never open files themselves: they ask a ``Tables`` for a logical table
and get the DataFrame the caller registered under that name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

_LOOKUP = ("id", "name")

# The columns the reports read, per logical table.
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    # history tables: several versions per record
    "courses": ("course_listing_id", "course_number", "name"),
    "reserves": ("course_listing_id", "item_id", "start_date", "end_date", "__current"),
    "course_listings": ("id", "term_id"),
    "terms": ("id", "name", "start_date", "end_date"),
    "loans": ("__id", "item_id", "action", "loan_date"),
    "check_ins": ("id", "item_id", "occurred_date_time", "item_status_prior_to_check_in"),
    "item_history": ("id", "barcode", "__current", "holdings_record_id"),
    "holdings_history": ("id", "instance_id", "permanent_location_id"),
    "instance_history": ("id", "title"),
    # raw records: key columns next to one JSON document
    "item_records": (
        "id", "jsonb", "creation_date", "holdingsrecordid", "materialtypeid",
        "permanentloantypeid", "temporaryloantypeid", "permanentlocationid",
        "temporarylocationid", "effectivelocationid",
    ),
    "instance_records": ("id", "jsonb"),
    # current tables: one row per id
    "items": (
        "id", "hrid", "barcode", "enumeration", "volume", "copy_number",
        "holdings_record_id", "effective_location_id",
    ),
    "holdings": ("id", "hrid", "call_number_prefix", "call_number", "instance_id"),
    "instances": (
        "id", "hrid", "cataloged_date", "title", "index_title", "instance_type_id",
        "mode_of_issuance_id", "previously_held", "source", "discovery_suppress",
        "staff_suppress", "status_id", "status_updated_date",
    ),
    # lookups
    "locations": _LOOKUP,
    "material_types": _LOOKUP,
    "loan_types": _LOOKUP,
    "service_points": _LOOKUP,
    "item_damaged_statuses": _LOOKUP,
    "call_number_types": _LOOKUP,
    "item_note_types": _LOOKUP,
    "instance_types": _LOOKUP,
    "modes_of_issuance": _LOOKUP,
    "instance_statuses": _LOOKUP,
    # pre-joined tables
    "holdings_ext": ("holdings_id", "instance_id"),
    "loans_items": ("loan_id", "item_id", "loan_date"),
    "locations_libraries": ("location_id", "location_code"),
    "instance_contributors": ("instance_id", "contributor_name", "contributor_is_primary"),
    # pre-joined tables that are built from the raw records when not registered
    "item_ext": (
        "item_id", "barcode", "effective_call_number_prefix", "effective_call_number",
        "volume", "copy_number", "holdings_record_id", "effective_location_id",
        "effective_location_name",
    ),
    "instance_ext": ("instance_id", "title"),
    "item_notes": ("item_id", "note"),
}

CURRENT_FLAG = "__current"

# Columns that end like an id and are none that is compared.
_NOT_IDS = ("__id", "hrid")


def is_id(column: str) -> bool:
    return column.endswith("id") and column not in _NOT_IDS


Source = DataFrame | Callable[[], DataFrame]


#: Key in a column's metadata: its ids are stored in lower case.
STORED_LOWER = "shelfmark.lower_ids"


def store_lower_ids(table: DataFrame) -> DataFrame:
    """The table with its ids in lower case, marked as such; the mark goes where it is written.

    Parquet files and catalog tables keep the mark, and ``Tables`` reads marked columns as they
    are, so that filters on ids reach the files and bucketed tables join without a shuffle.
    """
    return table.select(*(
        F.lower(F.col(name)).alias(name, metadata={STORED_LOWER: True}) if kind == "string" and is_id(name)
        else F.col(name) for name, kind in table.dtypes
    ))


class Tables:
    """Logical table name -> DataFrame, checked against ``REQUIRED_COLUMNS`` on access.

    A table may be given as a function that opens it; it is called on first use, so a
    report opens only the tables it reads.

    Ids are equal whatever their case, so id columns that hold text are read in lower case.
    Columns known to hold them so are taken as they are, which keeps their bucketing and lets
    filters on ids reach the files: those marked by ``store_lower_ids``, those named in
    ``stored_lower``, as ``table`` or ``table.column``, and all with ``lower_ids=False``.
    """

    def __init__(
        self, sources: Mapping[str, Source], lower_ids: bool = True, stored_lower: Iterable[str] = ()
    ):
        self._stored_lower = frozenset(stored_lower)
        named = set(sources) | {name.partition(".")[0] for name in self._stored_lower}
        unknown = sorted(named - set(REQUIRED_COLUMNS))
        if unknown:
            raise KeyError(f"not a logical table: {', '.join(unknown)}")
        self._sources = dict(sources)
        self._opened: dict[str, DataFrame] = {}
        self._lower_ids = lower_ids

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, root: str, names: Iterable[str] | Mapping[str, str],
        lower_ids: bool = True, stored_lower: Iterable[str] = (),
    ) -> Tables:
        """Read ``{root}/{name}`` for each logical name; a mapping gives other folder names."""
        folders = dict(names) if isinstance(names, Mapping) else {n: n for n in names}
        return cls({
            n: lambda path=f"{root}/{f}": spark.read.parquet(path) for n, f in folders.items()
        }, lower_ids, stored_lower)

    @classmethod
    def from_catalog(
        cls, spark: SparkSession, names: Mapping[str, str], lower_ids: bool = True,
        stored_lower: Iterable[str] = (),
    ) -> Tables:
        """Use catalog tables; ``names`` maps logical names to ``schema.table`` names."""
        sources = {n: lambda table=t: spark.table(table) for n, t in names.items()}
        return cls(sources, lower_ids, stored_lower)

    def __contains__(self, name: str) -> bool:
        return name in self._sources

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._sources:
            raise KeyError(f"table {name!r} is not registered")
        if name not in self._opened:
            source = self._sources[name]
            self._opened[name] = self._checked(name, source if isinstance(source, DataFrame) else source())
        return self._opened[name]

    def _checked(self, name: str, table: DataFrame) -> DataFrame:
        missing = [c for c in REQUIRED_COLUMNS[name] if c not in table.columns]
        if missing:
            raise ValueError(f"table {name!r} lacks the columns {', '.join(missing)}")
        if not self._lower_ids:
            return table
        ids = [c for c, kind in table.dtypes if kind == "string" and is_id(c) and not self._stored(name, table, c)]
        return table.withColumns({c: F.lower(F.col(c)) for c in ids}) if ids else table

    def _stored(self, name: str, table: DataFrame, column: str) -> bool:
        marked = table.schema[column].metadata.get(STORED_LOWER, False)
        return marked or not self._stored_lower.isdisjoint((name, f"{name}.{column}"))

    def with_tables(self, **sources: Source) -> Tables:
        """A registry with some tables added or replaced."""
        return Tables({**self._sources, **sources}, self._lower_ids, self._stored_lower)

    def current_versions(self) -> Tables:
        """A registry whose history tables keep only the rows flagged current.

        The reports count every version of a course, term, listing or loan; this
        view of the same data counts each record once.
        """

        def current(name: str) -> DataFrame:
            table = self[name]
            flagged = CURRENT_FLAG in table.columns
            return table.where(F.col(CURRENT_FLAG)) if flagged else table

        return Tables({n: lambda name=n: current(name) for n in self._sources}, self._lower_ids, self._stored_lower)
