"""The registered queries as plain SQL over the test tables, for DuckDB.

Written as directly as SQL allows: versions and loans are joined row by row and counted
afterwards, a course's term is picked by a lateral subquery over all its candidates. Nothing is condensed
early, so the SQL does not share the shortcuts of the Spark code.
"""

from __future__ import annotations

from fixtures import key, view_sql

_TERM_VIEWS = ("terms", "course_listings", "courses")
_ITEM_VIEWS = ("item_records", "items", "holdings_ext", "instances")

_CODE = r"regexp_replace(upper(trim(course_number)), '([A-Z])([0-9])', '\1 \2', 'g')"

# A row per item with what course-reserve reports show of it.
_SHELF = """shelf as (
    select record.id as item_id, flat.barcode as item_barcode,
        json_extract_string(record.jsonb, '$.effectiveCallNumberComponents.callNumber') as call_number,
        instances.title as instance_title
    from item_records record
    left join items flat on flat.id = record.id
    left join holdings_ext on holdings_ext.holdings_id = record.holdingsrecordid
    left join instances on instances.id = holdings_ext.instance_id)"""


def _with(views: tuple[str, ...], *tables: str) -> str:
    return "with " + ",\n".join([view_sql(*views), *tables]) + "\n"


def _resolved(allowed: tuple[str, ...] | None = None, preferred: str | None = None) -> str:
    """The first term of each course, picked course by course among all its candidates."""
    only = "" if allowed is None else (
        "and term.name in (" + ", ".join(f"'{a}'" for a in allowed) + ")"
    )
    prefer = "" if preferred is None else f"(term.name <> '{preferred}'),"
    return f"""resolved as (
    select course.course_listing_id, course.course_number, best.course_term, best.term_start,
        best.term_end
    from (select distinct course_listing_id, course_number from courses) course,
    lateral (
        select term.name as course_term, term.start_date as term_start, term.end_date as term_end
        from courses peer
        join course_listings listing on listing.id = peer.course_listing_id
        join terms term on term.id = listing.term_id
        where peer.course_number = course.course_number
            and (listing.id = course.course_listing_id
                or peer.course_listing_id <> course.course_listing_id)
            {only}
        order by (listing.id <> course.course_listing_id), {prefer}
            term.start_date desc nulls first, term.name, term.id
        limit 1) best)"""


_SAME_COURSE = """resolved.course_listing_id = courses.course_listing_id
        and resolved.course_number is not distinct from courses.course_number"""

_DATED_COLUMNS = """course_term, courses.course_number, item_barcode, call_number, instance_title,
    cast(count(loans.__id) as bigint) as checkout_count,
    case when reserves.__current then 1 else 0 end as is_current,
    courses.course_listing_id, reserves.item_id,
    reserves.start_date as reserves_start_date, reserves.end_date as reserves_end_date"""
_DATED_GROUPS = """course_term, courses.course_number, item_barcode, call_number, instance_title,
    reserves.__current, courses.course_listing_id, reserves.item_id,
    reserves.start_date, reserves.end_date, term_start, term_end"""
_SHORT_COLUMNS = """course_term, courses.course_number, item_barcode, call_number, instance_title,
    cast(count(loans.__id) as bigint) as checkout_count, courses.course_listing_id,
    reserves.item_id"""
_SHORT_GROUPS = """course_term, courses.course_number, item_barcode, call_number, instance_title,
    courses.course_listing_id, reserves.item_id"""


def _reserves(
    columns: str, groups: str, resolved: str, loan_test: str, where: str, window: str = ""
) -> str:
    tables = [_SHELF, resolved] + ([window] if window else [])
    views = (*_TERM_VIEWS, *_ITEM_VIEWS, "reserves", "loans")
    return _with(views, *tables) + f"""select {columns}
from courses
join reserves on reserves.course_listing_id = courses.course_listing_id
left join resolved on {_SAME_COURSE}
left join shelf on shelf.item_id = reserves.item_id
left join loans on loans.item_id = shelf.item_id and loans.action = 'checkedout'
    and {loan_test}
where reserves.item_id is not null and {where}
group by {groups}"""


def _term_dates(name: str) -> str:
    return f"""term_dates as (
    select start_date as first, end_date as last from terms where name = '{name}'
    order by start_date nulls last, end_date nulls last, id limit 1)"""


_IN_TERM = "loans.loan_date between (select first from term_dates) and (select last from term_dates)"


def _loaned(first: str, last: str) -> str:
    return f"loans.loan_date between date '{first}' and date '{last}'"


def _notes(path: str) -> str:
    """One row per element, with its place counted from 1."""
    return f"""elements as (
    select id, jsonb, place, json_extract(jsonb, '$.{path}[' || (place - 1) || ']') as element
    from (
        select id, jsonb, unnest(generate_series(1, cast(json_array_length(jsonb, '$.{path}') as bigint))) as place
        from item_records) numbered)"""


def _json(path: str, of: str = "record.jsonb") -> str:
    return f"json_extract_string({of}, '$.{path}')"


# The arrays of the fixture hold strings without commas.
_FORMER_IDS = f"replace({_json('formerIds')}, ',', ', ')"
_STATUS = (
    """'{"date": ' || cast(record.jsonb -> '$.status.date' as string) || ', "name": ' ||"""
    """ cast(record.jsonb -> '$.status.name' as string) || '}'"""
)


_DAYS_BY_WINDOW = _with(
    ("terms", "loans"),
    """wanted as (
    select distinct loans.item_id, terms.start_date as window_start, terms.end_date as window_end
    from loans join terms on cast(right(terms.id, 12) as bigint) = cast(right(loans.item_id, 12) as bigint) % 25
    where terms.start_date is not null)""",
) + """select wanted.item_id, window_start, window_end, cast(count(__id) as bigint) as checkouts
from wanted join loans on loans.item_id = wanted.item_id and loans.action = 'checkedout'
    and loans.loan_date between window_start and window_end
group by wanted.item_id, window_start, window_end"""

_CURRENT = "coalesce(reserves.__current, false)"

ORACLE: dict[str, str] = {
    "reserves_permanent": _reserves(
        _DATED_COLUMNS, _DATED_GROUPS, _resolved(), _loaned("1996-01-01", "1998-12-31"),
        f"course_term = 'Permanent' and {_CURRENT}",
    ),
    "reserves_permanent_codes": _reserves(
        _DATED_COLUMNS, _DATED_GROUPS, _resolved(), _loaned("0001-01-01", "9999-12-31"),
        f"course_term = 'Permanent' and {_CODE.replace('course_number', 'courses.course_number')} "
        "in ('AUTO 3', 'MACH 4', 'BUIL 12', 'POP')",
    ),
    "reserves_quarter_term": _reserves(
        _SHORT_COLUMNS, _SHORT_GROUPS, _resolved(("1996 Q3", "Permanent"), "1996 Q3"), _IN_TERM,
        f"{_CURRENT} and course_term is not null", _term_dates("1996 Q3"),
    ),
    "reserves_quarter_dates": _reserves(
        _SHORT_COLUMNS, _SHORT_GROUPS, _resolved(), _loaned("1996-07-01", "1996-09-28"), _CURRENT,
    ),
    "reserves_quarter_exclusions": _reserves(
        _SHORT_COLUMNS, _SHORT_GROUPS, _resolved(), _loaned("1996-07-01", "1996-09-28"),
        "courses.course_number is distinct from 'POP' and courses.course_number not ilike 'LAW%'",
    ),
    "reserves_quarter_unknown_term": _reserves(
        _SHORT_COLUMNS, _SHORT_GROUPS, _resolved(("1890 Q1", "Permanent"), "1890 Q1"), _IN_TERM,
        f"{_CURRENT} and course_term is not null", _term_dates("1890 Q1"),
    ),
    "reserves_quarter_course": _reserves(
        _DATED_COLUMNS, _DATED_GROUPS, _resolved(("1996 Q3", "Permanent"), "1996 Q3"),
        "loans.loan_date between coalesce(term_start, (select first from term_dates)) "
        "and coalesce(term_end, (select last from term_dates))",
        f"{_CURRENT} and course_term is not null and "
        f"{_CODE.replace('course_number', 'courses.course_number')} "
        "in ('AUTO 3', 'MACH 4', 'HOUS 7', 'FURN 10', 'BUIL 12', 'POP', 'LAW 6')",
        _term_dates("1996 Q3"),
    ),
    "reserves_quarter_course_history": _reserves(
        _DATED_COLUMNS, _DATED_GROUPS, _resolved(),
        "loans.loan_date between coalesce(term_start, date '1996-01-01') "
        "and coalesce(term_end, date '1997-12-31')",
        "courses.course_number is distinct from 'NEW' "
        "and courses.course_number is not null and courses.course_number <> ''",
    ),
    "reserves_listings_only": _reserves(
        _DATED_COLUMNS, _DATED_GROUPS, _resolved(("1997 Q2",)), "reserves.__current",
        "reserves.start_date is null and course_term is not null "
        "and (coalesce(courses.course_number, '') = '' or courses.course_number not ilike 'LAW%')",
    ),
    "reserves_listings_only_codes": _reserves(
        _DATED_COLUMNS, _DATED_GROUPS, _resolved(), "true",
        "reserves.start_date is null and "
        f"{_CODE.replace('course_number', 'courses.course_number')} in ('AUTO 3', 'MACH 4', '')",
    ),
    "circ_stats_course_reserves": _with(
        (*_ITEM_VIEWS, "courses", "reserves", "loans_items"), _SHELF,
        """lent as (
    select item_id, count(loan_id) as loans from loans_items
    where cast(loan_date as date) between date '1996-01-01' and date '1997-06-30'
    group by item_id)""",
    ) + """select distinct item_barcode, instance_title, cast(lent.loans as bigint) as circ_count
from courses
join reserves on reserves.course_listing_id = courses.course_listing_id
join lent on lent.item_id = reserves.item_id
left join shelf on shelf.item_id = reserves.item_id
where regexp_matches(courses.name, 'CUSTOMER#0+[0-4]', 'i')""",
    "class_list": _with(
        (*_ITEM_VIEWS, "locations", "locations_libraries"), _notes("notes")
    ) + f"""select distinct flat.barcode as item_barcode, location_code,
    locations.name as location_name,
    trim(concat({_json('effectiveCallNumberComponents.prefix')}, ' ',
        {_json('effectiveCallNumberComponents.callNumber')}, ' ',
        {_json('effectiveCallNumberComponents.callNumber')}, ' ',
        {_json('volume')}, ' ', {_json('copyNumber')})) as item_call_number,
    instances.title as instance_title, {_json('note', 'element')} as item_note
from elements
join item_records record on record.id = elements.id
left join items flat on flat.id = record.id
left join holdings_ext on holdings_ext.holdings_id = record.holdingsrecordid
left join instances on instances.id = holdings_ext.instance_id
left join locations on locations.id = record.effectivelocationid
left join locations_libraries on location_id = record.effectivelocationid
where regexp_matches({_json('note', 'element')}, '^(RED|blue) |econ', 'i')""",
    "circulation_history": _with(("check_ins", "item_history")) + """select check_ins.id as check_in_id,
    cast(occurred_date_time as date) as check_in_date
from check_ins join item_history on item_history.id = check_ins.item_id
where __current and barcode = 'B8' and item_status_prior_to_check_in = 'Checked out'
    and occurred_date_time >= date '2024-01-05' and occurred_date_time <= date '2024-01-25'""",
    "circulation_history_by_item": _with(("check_ins", "item_history")) + """select check_ins.id as check_in_id,
    cast(occurred_date_time as date) as check_in_date, barcode
from check_ins join item_history on item_history.id = check_ins.item_id
where __current and item_status_prior_to_check_in = 'Checked out'
    and barcode in (select barcode from item_history)
    and occurred_date_time >= date '2000-01-01' and occurred_date_time <= date '2099-01-01'""",
    "internal_use_count": _with(("check_ins", "item_history")) + """select cast(count(check_ins.id) as int) as internal_use_count
from check_ins join item_history on item_history.id = check_ins.item_id
where __current and barcode = 'B8' and item_status_prior_to_check_in = 'Available'""",
    "internal_use_by_item": _with(("check_ins", "item_history")) + """select barcode, cast(count(check_ins.id) as int) as internal_use_count
from item_history
left join check_ins on item_history.id = check_ins.item_id
    and item_status_prior_to_check_in = 'Available'
where __current and barcode is not null
group by barcode""",
    "collection_inventory": _with(
        ("items", "holdings", "instances", "instance_contributors", "locations")
    ) + """select distinct locations.name as location, index_title, contributor_name,
    concat('Curr ', call_number) as call_number, volume, copy_number,
    'https://catalog.example.org/Record/' ||
        case when starts_with(instances.hrid, 'b') then substr(instances.hrid, 1, 8)
        else instances.hrid end as link,
    barcode as item_barcode, items.id as item_id, holdings.id as holdings_id
from items
join holdings on holdings.id = items.holdings_record_id
join instances on instances.id = holdings.instance_id
join instance_contributors on instance_contributors.instance_id = instances.id
left join locations on locations.id = items.effective_location_id
where call_number_prefix = 'Curr' and contributor_is_primary""",
    "note_type_items": _with(
        ("item_records", "holdings", "instances", "item_note_types", "locations", "material_types"),
        _notes("notes"),
    ) + f"""select cast(discovery_suppress as string) as discovery_suppress, {_json('hrid')} as item_hrid,
    holdings.hrid as holdings_hrid, locations.name as item_location,
    {_json('barcode')} as barcode, {_FORMER_IDS} as formerids, call_number,
    {_json('effectiveShelvingOrder')} as shelving_order, material_types.name as material_type,
    title, item_note_types.name as note_type_name, {_json('note', 'element')} as note,
    {_json('staffOnly', 'element')} as staff_only, cast(place as int) as note_ordinality
from elements
join item_records record on record.id = elements.id
join item_note_types on item_note_types.id = {_json('itemNoteTypeId', 'element')}
left join holdings on holdings.id = record.holdingsrecordid
left join instances on instances.id = holdings.instance_id
left join locations on locations.id = record.effectivelocationid
left join material_types on material_types.id = record.materialtypeid
where item_note_types.id = '{key(0)}'""",
    "instance_ext": _with(
        ("instances", "instance_records", "instance_types", "modes_of_issuance", "instance_statuses")
    ) + f"""select instances.id as instance_id, hrid as instance_hrid,
    cast(cataloged_date as date) as cataloged_date, title, index_title,
    instance_type_id as type_id, instance_types.name as type_name, mode_of_issuance_id,
    modes_of_issuance.name as mode_of_issuance_name,
    coalesce(previously_held, false) as previously_held, source as instance_source,
    coalesce(discovery_suppress, false) as discovery_suppress,
    coalesce(staff_suppress, false) as staff_suppress, status_id,
    instance_statuses.name as status_name, status_updated_date, source as record_source,
    cast(substr({_json('metadata.createdDate')}, 1, 23) as timestamp) as record_created_date,
    lower({_json('metadata.updatedByUserId')}) as updated_by_user_id,
    cast(substr({_json('metadata.updatedDate')}, 1, 23) as timestamp) as updated_date,
    lower({_json('matchKey')}) as match_key,
    coalesce({_json('isBoundWith')} = 'true', false) as is_bound_with
from instances
left join instance_records record on record.id = instances.id
left join instance_types on instance_types.id = instance_type_id
left join modes_of_issuance on modes_of_issuance.id = mode_of_issuance_id
left join instance_statuses on instance_statuses.id = status_id""",
    "item_ext": _with(
        ("item_records", "items", "service_points", "material_types", "loan_types", "locations",
         "item_damaged_statuses", "call_number_types")
    ) + f"""select record.id as item_id, flat.hrid as item_hrid, {_json('accessionNumber')} as accession_number,
    flat.barcode, {_json('chronology')} as chronology, {_json('copyNumber')} as copy_number,
    flat.enumeration, {_json('volume')} as volume,
    {_json('inTransitDestinationServicePointId')} as in_transit_destination_service_point_id,
    point.name as in_transit_destination_service_point_name,
    {_json('itemIdentifier')} as identifier, {_json('itemLevelCallNumber')} as call_number,
    {_json('itemLevelCallNumberTypeId')} as call_number_type_id, own_type.name as call_number_type_name,
    {_json('effectiveCallNumberComponents.prefix')} as effective_call_number_prefix,
    {_json('effectiveCallNumberComponents.callNumber')} as effective_call_number,
    {_json('effectiveCallNumberComponents.suffix')} as effective_call_number_suffix,
    {_json('effectiveCallNumberComponents.typeId')} as effective_call_number_type_id,
    effective_type.name as effective_call_number_type_name,
    {_json('itemDamagedStatusId')} as damaged_status_id, damage.name as damaged_status_name,
    record.materialtypeid as material_type_id, material.name as material_type_name,
    {_json('numberOfPieces')} as number_of_pieces,
    {_json('numberOfMissingPieces')} as number_of_missing_pieces,
    record.permanentloantypeid as permanent_loan_type_id, own_loan.name as permanent_loan_type_name,
    record.temporaryloantypeid as temporary_loan_type_id, brief_loan.name as temporary_loan_type_name,
    record.permanentlocationid as permanent_location_id, own_place.name as permanent_location_name,
    record.temporarylocationid as temporary_location_id, brief_place.name as temporary_location_name,
    record.effectivelocationid as effective_location_id, place.name as effective_location_name,
    {_json('descriptionOfPieces')} as description_of_pieces, {_json('status.date')} as status_date,
    {_json('status.name')} as status_name, record.holdingsrecordid as holdings_record_id,
    {_json('discoverySuppress')} = 'true' as discovery_suppress,
    record.creation_date as created_date,
    lower({_json('metadata.updatedByUserId')}) as updated_by_user_id,
    {_json('metadata.updatedDate')} as updated_date
from item_records record
left join items flat on flat.id = record.id
left join service_points point on point.id = {_json('inTransitDestinationServicePointId')}
left join material_types material on material.id = record.materialtypeid
left join loan_types own_loan on own_loan.id = record.permanentloantypeid
left join loan_types brief_loan on brief_loan.id = record.temporaryloantypeid
left join locations own_place on own_place.id = record.permanentlocationid
left join locations brief_place on brief_place.id = record.temporarylocationid
left join locations place on place.id = record.effectivelocationid
left join item_damaged_statuses damage on damage.id = {_json('itemDamagedStatusId')}
left join call_number_types own_type on own_type.id = {_json('itemLevelCallNumberTypeId')}
left join call_number_types effective_type
    on effective_type.id = {_json('effectiveCallNumberComponents.typeId')}""",
    "item_circulation_notes": _with(("item_records",), _notes("circulationNotes")) + f"""select id as item_id,
    lower({_json('id', 'element')}) as note_id, {_json('note', 'element')} as note,
    {_json('noteType', 'element')} as note_type,
    {_json('staffOnly', 'element')} = 'true' as staff_only, cast(place as bigint) as ordinality
from elements""",
    "zero_use_items": _with(
        ("item_history", "holdings_history", "instance_history", "check_ins")
    ) + f"""select item_history.id as item_id, title
from item_history
join holdings_history on holdings_history.id = item_history.holdings_record_id
join instance_history on instance_history.id = holdings_history.instance_id
where __current and permanent_location_id = '{key(2)}' and not exists (
    select 1 from check_ins where check_ins.item_id = item_history.id
        and occurred_date_time between date '2024-01-03' and date '2024-01-20')""",
    # operators
    "checkouts_in_term": _with(("terms", "loans"), _term_dates("1996 Q3")) + f"""select item_id,
    cast(count(__id) as bigint) as checkouts
from loans where action = 'checkedout' and {_IN_TERM} group by item_id""",
    "checkouts_fixed_window": _with(("loans",)) + f"""select item_id, cast(count(__id) as bigint) as checkouts
from loans where action = 'checkedout' and {_loaned('1996-02-01', '1996-11-30')} group by item_id""",
    "checkouts_row_window": _DAYS_BY_WINDOW,
    "loans_whole_days": _with(("loans_items",)) + """select item_id, cast(count(loan_id) as bigint) as loans
from loans_items where cast(loan_date as date) between date '1996-02-01' and date '1996-11-30'
group by item_id""",
    "resolve_term": _with(_TERM_VIEWS, _resolved()) + f"""select courses.course_listing_id,
    courses.course_number, cast(count(*) as bigint) as course_versions, course_term, term_start, term_end
from courses left join resolved on {_SAME_COURSE}
group by courses.course_listing_id, courses.course_number, course_term, term_start, term_end""",
    "resolve_term_preferred": _with(
        _TERM_VIEWS, _resolved(("1999 Q4", "Permanent", "1997 Q1"), "1997 Q1")
    ) + f"""select courses.course_listing_id, courses.course_number,
    cast(count(*) as bigint) as course_versions, course_term, term_start, term_end
from courses left join resolved on {_SAME_COURSE}
group by courses.course_listing_id, courses.course_number, course_term, term_start, term_end""",
    "course_code_match": _with(("courses",)) + f"""select id, course_number, __current from courses
where {_CODE} in ('AUTO 3', 'MACH 4', 'LAW 6', '')""",
    "course_code_match_table": _with(("courses",)) + f"""select id, course_number from courses
where {_CODE} in (select 'MACH ' || cast(n_nationkey as string) from nation)""",
    "exclusion_flags": _with(("courses",)) + """select id, course_number from courses
where course_number is distinct from 'POP' and course_number not ilike 'LAW%'
    and course_number is distinct from 'NEW' and course_number is not null and course_number <> ''""",
    "exclusion_flags_legacy": _with(("courses",)) + """select id, course_number from courses
where course_number is null or course_number = '' or course_number not ilike 'LAW%'""",
    "history_toggle": _with(("reserves",)) + """select id, item_id, __current, 'all' as kept from reserves
union all select id, item_id, __current, 'current' from reserves where __current""",
    "regex_filter": _with(("courses",)) + """select id, name from courses
where regexp_matches(name, 'mer#0+[1-9]*7$', 'i')""",
    "regex_dialect": _with(("courses",)) + """select id,
    regexp_matches(name, '(^|[^a-zA-Z0-9_])customer($|[^a-zA-Z0-9_])', 'i') as whole_word,
    regexp_matches(name, '(^|[^a-zA-Z0-9_])cust($|[^a-zA-Z0-9_])', 'i') as part_of_word,
    contains(name, '#0') as boundary,
    regexp_matches(name, '^[a-zA-Z]+#[0-9]{9}$') as classes,
    regexp_matches(name, '(^|[^a-zA-Z0-9_])c[^ ]*[02468]$', 'i') as word_start,
    list_bool_or(list_transform(range(1, 10), lambda d: contains(name, d::varchar || d::varchar))) as same_digit,
    contains(name, 'customer') as "case"
from courses""",
    "json_container_text": _with(("item_records",)) + f"""select id, {_STATUS} as status
from item_records record""",
    "lookup_names": _with(("item_records", "locations", "loan_types")) + """select record.id,
    locations.name as location_name, loan_types.name as loan_type_name
from item_records record
left join locations on locations.id = permanentlocationid
left join loan_types on loan_types.id = temporaryloantypeid""",
    "explode_notes": _with(("item_records",), _notes("notes")) + f"""select id,
    {_json('note', 'element')} as note, {_json('itemNoteTypeId', 'element')} as "itemNoteTypeId",
    cast(place as bigint) as ordinality from elements""",
    "json_fields": _with(("item_records",)) + f"""select id, {_json('volume')} as volume,
    {_json('status.name')} as status_name, {_json('numberOfPieces')} as pieces,
    {_json('discoverySuppress')} as suppressed, {_FORMER_IDS} as former_ids
from item_records record""",
    "null_skipping_concat": _with(("holdings",)) + """select id,
    trim(concat(call_number_prefix, ' ', call_number, ' ', hrid)) as call_number from holdings""",
    "catalog_link": _with(("instances",)) + """select id, 'https://catalog.example.org/Record/' ||
    case when starts_with(hrid, 'b') then substr(hrid, 1, 8) else hrid end as link from instances""",
    "left_anti": _with(("item_history", "check_ins")) + """select id, barcode from item_history
where not exists (select 1 from check_ins where check_ins.item_id = item_history.id)""",
    "global_count_empty": _with(("check_ins", "item_history")) + """select
    cast(count(check_ins.id) as int) as internal_use_count
from check_ins join item_history on item_history.id = check_ins.item_id
where __current and barcode = 'no such barcode'""",
    "conform_schema": _with(("check_ins",)) + """select id as event,
    cast(occurred_date_time as date) as day, cast(length(item_id) as bigint) as id_length,
    case when item_status_prior_to_check_in = 'Available' then 'true' else 'false' end as was_available
from check_ins""",
    "group_distinct": _with(("loans",)) + "select distinct item_id, action from loans",
    "current_versions": _with(("courses",)) + """select id, course_number from courses where __current""",
}
