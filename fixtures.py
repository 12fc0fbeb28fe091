"""Library tables made from the test data, the same way for Spark and for DuckDB.

Each view is a projection of one test table, written in SQL expressions both engines read
alike. ``library(spark, sf_dir)`` gives them as a ``Tables`` registry; ``view_sql(names)``
gives the same views as common table expressions for an oracle query.

The views of terms, listings, courses, reserves, loans and check-ins are those of
FIXTURES.md. Items and instances carry all the columns and document fields the wide tables
need, and instances come from ``customer`` so that their number grows with the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from shelfmark import Tables


@dataclass(frozen=True)
class View:
    source: str
    columns: dict[str, str]
    # A second projection of the same source, added to the rows of the first.
    also: View | None = None

    def frame(self, source: DataFrame) -> DataFrame:
        rows = source.selectExpr(*(f"{e} as `{n}`" for n, e in self.columns.items()))
        return rows.unionAll(self.also.frame(source)) if self.also else rows

    def sql(self) -> str:
        """The view as a subquery. Ids are in lower case here, as uuid values compare."""
        picked = ", ".join(
            f'lower({e}) as "{n}"' if _is_key(n, e) else f'{e} as "{n}"'
            for n, e in self.columns.items()
        )
        text = f"select {picked} from {self.source}"
        return f"{text} union all {self.also.sql()}" if self.also else text


# The columns of the test tables that the views use. Declared, so that opening a table
# needs no look into its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_returnflag string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def _text(expression: str) -> str:
    return f"cast({expression} as string)"


# Ids as table columns hold them, and as documents do; all but their case is the same.
_PREFIX = "0000ABCD-0000-4000-8000-"


def _key(number: str) -> str:
    return f"'{_PREFIX}' || lpad({_text(number)}, 12, '0')"


def _document_key(number: str) -> str:
    return f"'{_PREFIX.lower()}' || lpad({_text(number)}, 12, '0')"


def key(number: int) -> str:
    """The id that stands for a number, as results show it."""
    return f"{_PREFIX.lower()}{number:012d}"


def _is_key(name: str, expression: str) -> bool:
    return _PREFIX in expression


_TERM_YEAR = "1995 + cast(floor((n_nationkey - 1) / 4) as int)"
_TERM_MONTH = "cast((n_nationkey - 1) % 4 * 3 + {} as int)"
_NO_TERM_DATE = "when n_nationkey = 0 then cast(null as date)"

TERMS = View("nation", {
    "id": _key("n_nationkey"),
    "name": (
        f"case when n_nationkey = 0 then 'Permanent' else {_text(_TERM_YEAR)} || ' Q' || "
        f"{_text('(n_nationkey - 1) % 4 + 1')} end"
    ),
    "start_date": f"case {_NO_TERM_DATE} else make_date({_TERM_YEAR}, {_TERM_MONTH.format(1)}, 1) end",
    "end_date": f"case {_NO_TERM_DATE} else make_date({_TERM_YEAR}, {_TERM_MONTH.format(3)}, 28) end",
})

# Every 13th listing has an id that no course names.
COURSE_LISTINGS = View("customer", {
    "id": f"case when c_custkey % 13 = 12 then 'other ' else '' end || {_key('c_custkey')}",
    "term_id": (
        f"case when c_custkey % 11 = 10 then cast(null as string) when c_custkey % 3 = 0 then {_key('0')} "
        f"else {_key('c_custkey % 25')} end"
    ),
})

_COURSE = {
    "id": _key("c_custkey"),
    "course_listing_id": _key("c_custkey"),
    "name": "c_name",
    "course_number": (
        "case when c_custkey % 20 = 0 then 'POP' when c_custkey % 20 = 1 then 'NEW' "
        "when c_custkey % 20 = 2 then '' when c_custkey % 20 = 3 then cast(null as string) "
        f"when c_custkey % 20 = 4 then 'LAW ' || {_text('c_nationkey')} "
        f"when c_custkey % 20 = 5 then 'law' || {_text('c_nationkey')} "
        "else substr(c_mktsegment, 1, 4) || case when c_custkey % 2 = 0 then '' else ' ' end || "
        f"{_text('c_nationkey')} end"
    ),
}
# Every course has a former version; of some it has the same listing, so that both count.
COURSES = View(
    "customer", {**_COURSE, "__current": "true"},
    also=View("customer", {
        **_COURSE,
        "course_listing_id": f"case when c_custkey % 40 = 7 then '' else 'former ' end || {_key('c_custkey')}",
        "__current": "false",
    }),
)

RESERVES = View("orders", {
    "id": _key("o_orderkey"),
    "course_listing_id": _key("o_custkey"),
    # One item is on a tenth of all reserves; the others spread over half of all items.
    "item_id": (
        "case when o_orderkey % 17 = 16 then cast(null as string) "
        f"when o_orderkey % 10 = 7 then {_key('7')} "
        f"else {_key('cast(floor(o_orderkey / 15) as bigint)')} end"
    ),
    "start_date": "case when o_orderkey % 4 = 0 then cast(null as date) else cast(o_orderdate as date) end",
    "end_date": (
        "case when o_orderkey % 4 = 0 then cast(null as date) "
        "else cast(o_orderdate + interval 90 day as date) end"
    ),
    "__current": "o_orderstatus <> 'F'",
})

_LOAN_DATE = "l_shipdate + interval 9 hour"

LOANS = View("lineitem", {
    "__id": "l_orderkey * 10 + l_linenumber",
    "item_id": _key("l_partkey"),
    "action": "case when l_returnflag = 'R' then 'checkedin' else 'checkedout' end",
    "loan_date": _LOAN_DATE,
})

LOANS_ITEMS = View("lineitem", {
    "loan_id": _key("l_orderkey * 10 + l_linenumber"),
    "item_id": _key("l_partkey"),
    "loan_date": _LOAN_DATE,
})

CHECK_INS = View("events", {
    "id": _key("event_id"),
    "item_id": _key("user_id"),
    "occurred_date_time": "ts",
    "item_status_prior_to_check_in": (
        "case event_type when 'purchase' then 'Checked out' when 'view' then 'Available' "
        "else 'In transit' end"
    ),
})


def _field(name: str, value: str) -> str:
    return f""" || ',"{name}":' || {value}"""


def _quoted(value: str) -> str:
    return f"""'"' || {value} || '"'"""


_PART = _text("p_partkey")
_SIZE = _text("p_size")
_ITEM_DOCUMENT = (
    f"""'{{"hrid":"it' || {_PART} || '"'"""
    + _field("barcode", f"case when p_partkey % 29 = 28 then 'null' else {_quoted(f"'B' || {_PART}")} end")
    + _field("accessionNumber", f"case when p_partkey % 4 = 0 then 'null' else {_quoted(f"'ac' || {_PART}")} end")
    + _field("chronology", _quoted(f"'c. ' || {_SIZE}"))
    + _field("volume", f"case when p_size % 3 = 0 then 'null' else {_quoted(f"'v.' || {_SIZE}")} end")
    + _field("copyNumber", _quoted(f"'c' || {_text('p_partkey % 3')}"))
    + _field("inTransitDestinationServicePointId", f"case when p_size % 4 = 1 then {_quoted(_document_key('p_size % 9'))} else 'null' end")
    + _field("itemIdentifier", _quoted(f"'id-' || {_PART}"))
    + _field("itemLevelCallNumber", f"case when p_size % 5 = 2 then 'null' else {_quoted('p_type')} end")
    + _field("itemLevelCallNumberTypeId", _quoted(_document_key("p_partkey % 6")))
    + """ || ',"effectiveCallNumberComponents":{"callNumber":"' || p_brand || '"' ||"""
    + """ case when p_size % 3 = 1 then '' else ',"prefix":"Curr","suffix":null' end ||"""
    + f""" ',"typeId":"' || {_document_key('p_size % 8')} || '"}}'"""
    + _field("itemDamagedStatusId", f"case when p_size % 10 = 0 then {_quoted(_document_key('p_size % 7'))} else 'null' end")
    + _field("numberOfPieces", _text("p_size % 3 + 1"))
    + _field("numberOfMissingPieces", "case when p_size % 7 = 0 then '1' else 'null' end")
    + _field("descriptionOfPieces", _quoted("p_name"))
    + """ || ',"status":{"name":"' || case when p_size % 2 = 0 then 'Available' else 'Checked out' end ||"""
    + """ '","date":"2024-01-01T00:00:00.000+00:00"}'"""
    + f""" || ',"metadata":{{"updatedByUserId":"' || {_document_key('p_partkey % 50')} || '","updatedDate":"2024-02-0' || {_text('p_size % 9 + 1')} || 'T08:30:00.000+00:00"}}'"""
    + _field("discoverySuppress", "case when p_size % 5 = 0 then 'true' else 'false' end")
    + _field("formerIds", f"case when p_size % 2 = 0 then '[]' else '[' || {_quoted(f"'f' || {_PART}")} || ',' || {_quoted(f"'g' || {_PART}")} || ']' end")
    + _field("effectiveShelvingOrder", _quoted(f"p_brand || ' ' || {_SIZE}"))
    + """ || case when p_size % 6 = 5 then '' else ',"notes":[' || case when p_size % 4 = 0 then '' else"""
    + f""" '{{"note":"' || p_name || '","itemNoteTypeId":"' || {_document_key('p_size % 3')} || '","staffOnly":"' ||"""
    + """ case when p_size % 2 = 0 then 'true' else 'false' end ||"""
    + f""" '"}},{{"note":"' || p_type || '","itemNoteTypeId":"' || {_document_key('0')} || '","staffOnly":"false"}}' end ||"""
    + f""" '],"circulationNotes":[{{"id":"' || {_document_key('p_partkey')} || '","note":"' || p_type || '","noteType":"Check out","staffOnly":"true"}}]' end"""
    + """ || '}'"""
)

# A quarter of the items is under one of the holdings; the others spread over all of them.
_HOLDINGS_OF_PART = (
    f"case when p_partkey % 4 = 1 then {_key('3')} "
    f"else {_key('cast(floor(p_partkey / 20) as bigint)')} end"
)

ITEM_RECORDS = View("part", {
    "id": _key("p_partkey"),
    "jsonb": _ITEM_DOCUMENT,
    "creation_date": "cast('2020-01-01 06:00:00' as timestamp)",
    "holdingsrecordid": _HOLDINGS_OF_PART,
    "materialtypeid": _key("p_size % 7"),
    "permanentloantypeid": _key("p_size % 4"),
    "temporaryloantypeid": f"case when p_size % 3 = 0 then {_key('p_size % 6')} else cast(null as string) end",
    "permanentlocationid": _key("p_partkey % 6"),
    "temporarylocationid": f"case when p_size % 4 = 0 then {_key('p_size % 5')} else cast(null as string) end",
    "effectivelocationid": _key("p_partkey % 5"),
})

_BARCODE = f"case when p_partkey % 29 = 28 then cast(null as string) else 'B' || {_PART} end"

# Some flat items and instance documents belong to no record.
ITEMS = View("part", {
    "id": f"case when p_partkey % 37 = 36 then 'other ' else '' end || {_key('p_partkey')}",
    "hrid": f"'it' || {_PART}",
    "barcode": _BARCODE,
    "enumeration": f"'e' || {_SIZE}",
    "volume": f"case when p_size % 3 = 0 then cast(null as string) else 'v.' || {_SIZE} end",
    "copy_number": f"'c' || {_text('p_partkey % 3')}",
    "holdings_record_id": _HOLDINGS_OF_PART,
    "effective_location_id": _key("p_partkey % 5"),
})

# Every item has a former version with another barcode.
ITEM_HISTORY = View(
    "part", {
        "id": _key("p_partkey"), "barcode": _BARCODE, "__current": "p_partkey % 31 <> 30",
        "holdings_record_id": _HOLDINGS_OF_PART,
    },
    also=View("part", {
        "id": _key("p_partkey"), "barcode": f"'old' || {_PART}", "__current": "false",
        "holdings_record_id": _HOLDINGS_OF_PART,
    }),
)

_INSTANCE_OF_SUPPLIER = _key("s_suppkey * 15")

HOLDINGS = View("supplier", {
    "id": _key("s_suppkey"),
    "hrid": f"'ho' || {_text('s_suppkey')}",
    "call_number_prefix": (
        "case when s_suppkey % 3 = 0 then 'Curr' when s_suppkey % 3 = 1 then 'Ref' "
        "else cast(null as string) end"
    ),
    "call_number": "case when s_suppkey % 5 = 4 then cast(null as string) else s_name end",
    "instance_id": _INSTANCE_OF_SUPPLIER,
})

HOLDINGS_HISTORY = View("supplier", {
    "id": _key("s_suppkey"),
    "instance_id": _INSTANCE_OF_SUPPLIER,
    "permanent_location_id": _key("s_suppkey % 5"),
})

HOLDINGS_EXT = View("supplier", {
    "holdings_id": _key("s_suppkey"), "instance_id": _INSTANCE_OF_SUPPLIER,
})

_CUST = _text("c_custkey")
_INSTANCE_DOCUMENT = (
    f"""'{{"metadata":{{"createdDate":"2023-0' || {_text('c_custkey % 9 + 1')} || '-01T10:00:00.000+00:00"' ||"""
    + """ case when c_custkey % 4 = 0 then '' else ',"updatedByUserId":"0000abcd-0000-4000-8000-000000000007","updatedDate":"2023-12-31T23:15:00.000+00:00"' end || '}'"""
    + _field("matchKey", f"case when c_custkey % 5 = 0 then 'null' else {_quoted(_document_key('c_custkey'))} end")
    + _field("isBoundWith", "case when c_custkey % 3 = 0 then 'null' else 'true' end")
    + """ || '}'"""
)

INSTANCE_RECORDS = View("customer", {
    "id": f"case when c_custkey % 19 = 18 then 'other ' else '' end || {_key('c_custkey')}",
    "jsonb": _INSTANCE_DOCUMENT,
})

INSTANCES = View("customer", {
    "id": _key("c_custkey"),
    "hrid": f"case when c_custkey % 2 = 0 then 'b' || lpad({_CUST}, 7, '0') || 'x' else 'in' || {_CUST} end",
    "cataloged_date": f"case when c_custkey % 6 = 0 then cast(null as string) else '2019-05-0' || {_text('c_custkey % 9 + 1')} end",
    "title": f"'Title ' || {_text('c_custkey % 100')}",
    "index_title": f"'title ' || {_text('c_custkey % 100')}",
    "instance_type_id": _key("c_custkey % 5"),
    "mode_of_issuance_id": _key("c_custkey % 7"),
    "previously_held": "case when c_custkey % 3 = 0 then cast(null as boolean) else c_custkey % 2 = 0 end",
    "source": "case when c_custkey % 2 = 0 then 'MARC' else 'LOCAL' end",
    "discovery_suppress": "case when c_custkey % 7 = 0 then cast(null as boolean) else c_custkey % 2 = 0 end",
    "staff_suppress": "case when c_custkey % 5 = 0 then cast(null as boolean) else c_custkey % 4 = 1 end",
    "status_id": _key("c_custkey % 6"),
    "status_updated_date": "cast('2022-03-04 05:06:07' as timestamp)",
})

INSTANCE_HISTORY = View("customer", {"id": _key("c_custkey"), "title": f"'Title ' || {_text('c_custkey % 100')}"})

INSTANCE_CONTRIBUTORS = View("customer", {
    # Up to three contributors per instance, of which up to two are primary.
    "instance_id": _key("c_custkey - c_custkey % 3"),
    "contributor_name": "c_name",
    "contributor_is_primary": "c_custkey % 7 < 4",
})

LOOKUP = View("region", {"id": _key("r_regionkey"), "name": "r_name"})
LOCATIONS_LIBRARIES = View("region", {
    "location_id": _key("r_regionkey"), "location_code": f"'LOC' || {_text('r_regionkey')}",
})

LOOKUPS = (
    "locations", "material_types", "loan_types", "service_points", "item_damaged_statuses",
    "call_number_types", "item_note_types", "instance_types", "modes_of_issuance",
    "instance_statuses",
)

VIEWS: dict[str, View] = {
    "terms": TERMS,
    "course_listings": COURSE_LISTINGS,
    "courses": COURSES,
    "reserves": RESERVES,
    "loans": LOANS,
    "loans_items": LOANS_ITEMS,
    "check_ins": CHECK_INS,
    "item_records": ITEM_RECORDS,
    "items": ITEMS,
    "item_history": ITEM_HISTORY,
    "holdings": HOLDINGS,
    "holdings_history": HOLDINGS_HISTORY,
    "holdings_ext": HOLDINGS_EXT,
    "instance_records": INSTANCE_RECORDS,
    "instances": INSTANCES,
    "instance_history": INSTANCE_HISTORY,
    "instance_contributors": INSTANCE_CONTRIBUTORS,
    "locations_libraries": LOCATIONS_LIBRARIES,
    **{name: LOOKUP for name in LOOKUPS},
}


def library(spark: SparkSession, sf_dir: str) -> Tables:
    """The library tables over the Parquet files in ``sf_dir``."""
    # Day bounds and document times are read in the session's zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    @cache
    def source(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    return Tables({
        name: lambda v=view: v.frame(source(v.source)) for name, view in VIEWS.items()
    })


def view_sql(*names: str) -> str:
    """``name as (select ...)`` for each view, to follow ``with``."""
    return ",\n".join(f"{n} as ({VIEWS[n].sql()})" for n in names)
