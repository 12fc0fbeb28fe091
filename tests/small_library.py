"""A hand-made library whose every row stands for one special case."""

import datetime as dt
import json

from shelfmark import Tables

D, T = dt.date, dt.datetime


def uid(number: int) -> str:
    """An id as documents hold it, in upper case; results show it in lower case."""
    return f"ABCDEF00-0000-4000-8000-{number:012d}"



def tables(spark, **changed) -> Tables:
    """The small library; keyword arguments replace the rows of a table."""
    rows = {name: changed.get(name, default) for name, (_, default) in _TABLES.items()}
    return Tables({
        name: spark.createDataFrame(rows[name], schema) for name, (schema, _) in _TABLES.items()
    })


def document(**fields) -> str:
    return json.dumps(fields)


_LOOKUP = "id string, name string"

_TABLES = {
    "terms": ("id string, name string, start_date date, end_date date", [
        ("t-perm", "Permanent", None, None),
        ("t-w", "Winter", D(2024, 1, 1), D(2024, 3, 31)),
        ("t-s", "Spring", D(2024, 4, 1), D(2024, 6, 30)),
        ("t-s2", "Spring", D(2023, 4, 1), D(2023, 6, 30)),
    ]),
    "course_listings": ("id string, term_id string", [
        ("L1", "t-w"), ("L2", "t-s"), ("L3", "t-perm"), ("L4", None), ("L6", "t-w"),
        ("L7", "t-gone"),
    ]),
    "courses": (
        "course_listing_id string, course_number string, name string, __current boolean", [
            ("L1", "CS 101", "Intro", True),
            ("L2", "CS 101", "Intro", True),
            ("L3", "CS102", "Advanced", True),
            ("L4", "CS 101", "Intro", True),      # no own term: takes a peer's
            ("L5", "HIST 9", "History", True),    # no listing, no peer: no term
            ("L6", None, "Nameless", True),       # no number: no term
            ("L7", "LAW 1", "Torts", True),       # unknown term id
            ("L1", "CS 101", "Intro old", False), # a second version
        ]),
    "reserves": (
        "course_listing_id string, item_id string, start_date date, end_date date, "
        "__current boolean", [
            ("l1", "i1", D(2024, 1, 1), D(2024, 3, 1), True),
            ("l1", "i1", D(2023, 1, 1), D(2023, 3, 1), False),
            ("l2", "i1", None, None, True),
            ("l3", "i2", None, None, True),
            ("l3", "i2", None, D(2030, 1, 1), None),
            ("l4", "i2", None, None, True),
            ("l5", "i3", None, None, True),
            ("l6", "i1", None, None, True),
            ("l7", "i9", None, None, True),       # an item nobody knows
            ("l1", None, None, None, True),
        ]),
    "loans": ("__id bigint, item_id string, action string, loan_date timestamp", [
        (1, "i1", "checkedout", T(2024, 1, 1, 0, 0)),
        (2, "i1", "checkedout", T(2024, 3, 31, 0, 0)),
        (3, "i1", "checkedout", T(2024, 3, 31, 0, 0, 1)),   # past midnight of Winter's end
        (4, "i1", "checkedin", T(2024, 2, 1, 9, 0)),
        (5, "i1", "checkedout", T(2024, 5, 1, 9, 0)),
        (6, "i2", "checkedout", T(2024, 2, 1, 9, 0)),
        (None, "i2", "checkedout", T(2024, 2, 1, 9, 0)),    # no key: not counted
        (7, "i9", "checkedout", T(2024, 2, 1, 9, 0)),
        (8, "i2", "checkedout", None),
    ]),
    "loans_items": ("loan_id string, item_id string, loan_date timestamp", [
        ("1", "i1", T(2024, 1, 1, 23, 59)),
        ("2", "i1", T(2024, 1, 2, 0, 0)),
        ("3", "i2", T(2024, 1, 1, 8, 0)),
        ("4", "i9", T(2024, 1, 1, 8, 0)),
    ]),
    "check_ins": (
        "id string, item_id string, occurred_date_time timestamp, "
        "item_status_prior_to_check_in string", [
            ("c1", "i1", T(2024, 1, 1, 0, 0), "Checked out"),
            ("c2", "i1", T(2024, 1, 31, 0, 0), "Checked out"),
            ("c3", "i1", T(2024, 1, 31, 9, 0), "Checked out"),
            ("c4", "i1", T(2024, 1, 5, 9, 0), "Available"),
            ("c5", "i2", T(2024, 1, 5, 9, 0), "Checked out"),
        ]),
    "item_records": (
        "id string, jsonb string, creation_date timestamp, holdingsrecordid string, "
        "materialtypeid string, permanentloantypeid string, temporaryloantypeid string, "
        "permanentlocationid string, temporarylocationid string, effectivelocationid string", [
            ("i1", document(
                hrid="it1", barcode="B1", volume=None, numberOfPieces=3, discoverySuppress="on",
                copyNumber="c1", itemDamagedStatusId=uid(1), formerIds=["a", "b"],
                effectiveCallNumberComponents={"prefix": "Ref", "callNumber": "QA 1", "suffix": "x"},
                effectiveShelvingOrder="QA 11",
                notes=[
                    {"note": "Class of Latin", "itemNoteTypeId": uid(2), "staffOnly": "off"},
                    {"note": "plain", "itemNoteTypeId": uid(3).lower(), "staffOnly": True},
                    {"note": "latin again", "itemNoteTypeId": uid(2).lower(), "staffOnly": None},
                ],
                circulationNotes=[
                    {"id": uid(4), "note": "handle", "noteType": "Check in", "staffOnly": "yes"},
                    {"id": "not an id", "note": None, "noteType": "Check out", "staffOnly": "no"},
                ],
             ), T(2020, 1, 1), "h1", "m1", "l1", None, "loc1", None, "loc1"),
            ("i2", document(notes=[], effectiveCallNumberComponents=None, discoverySuppress=None),
             T(2020, 1, 2), "h2", "m9", "l1", "l2", "loc1", "loc2", "loc2"),
            ("i3", document(notes="not an array", circulationNotes=None, volume="v3"),
             None, None, None, None, None, None, None, None),
        ]),
    "items": (
        "id string, hrid string, barcode string, enumeration string, volume string, "
        "copy_number string, holdings_record_id string, effective_location_id string", [
            ("i1", "it1", "B1", "e1", "v1", "c1", "h1", "loc1"),
            ("i2", "it2", None, None, None, None, "h2", "loc9"),
        ]),
    "item_history": ("id string, barcode string, __current boolean, holdings_record_id string", [
        ("i1", "B1", True, "h1"), ("i1", "OLD", False, "h1"), ("i2", "B2", True, "h2"),
        ("i3", "B3", True, "h2"), ("i4", None, True, "h1"),
    ]),
    "holdings": (
        "id string, hrid string, call_number_prefix string, call_number string, "
        "instance_id string", [
            ("h1", "ho1", "Curr", "QA 1", "n1"), ("h2", "ho2", "Curr", None, "n2"),
            ("h3", "ho3", None, "QA 3", "n1"),
        ]),
    "holdings_history": ("id string, instance_id string, permanent_location_id string", [
        ("h1", "n1", "loc1"), ("h2", "n2", "loc1"),
    ]),
    "holdings_ext": ("holdings_id string, instance_id string", [("h1", "n1"), ("h2", "n2")]),
    "instance_records": ("id string, jsonb string", [
        ("n1", document(
            metadata={"createdDate": "2024-01-01T01:00:00.000+02:00", "updatedByUserId": "{" + uid(5).replace("-", "") + "} ",
                      "updatedDate": "2024-01-01T01:00:00.000+0200"},
            matchKey="KEY-1", isBoundWith=True,
        )),
    ]),
    "instances": (
        "id string, hrid string, cataloged_date string, title string, index_title string, "
        "instance_type_id string, mode_of_issuance_id string, previously_held boolean, "
        "source string, discovery_suppress boolean, staff_suppress boolean, status_id string, "
        "status_updated_date timestamp", [
            ("n1", "b1234567x", "2020-02-03", "Latin", "latin", "ty1", "mo1", None, "MARC", True,
             None, "s1", T(2024, 1, 1)),
            ("n2", "in22", None, "Greek", "greek", None, None, True, None, None, False, None, None),
        ]),
    "instance_history": ("id string, title string", [
        ("n1", "Latin"), ("n1", "Latin, new"), ("n2", "Greek"),
    ]),
    "instance_contributors": (
        "instance_id string, contributor_name string, contributor_is_primary boolean", [
            ("n1", "Ada", True), ("n1", "Ada", True), ("n1", "Bob", False), ("n2", "Cyd", None),
        ]),
    "locations": (_LOOKUP, [("loc1", "Stacks"), ("loc2", "Annex")]),
    "locations_libraries": ("location_id string, location_code string", [("loc1", "STK")]),
    "material_types": (_LOOKUP, [("m1", "book")]),
    "loan_types": (_LOOKUP, [("l1", "long"), ("l2", "short")]),
    "service_points": (_LOOKUP, [("sp1", "desk")]),
    "item_damaged_statuses": (_LOOKUP, [(uid(1), "torn")]),
    "call_number_types": (_LOOKUP, [("cn1", "LC")]),
    "item_note_types": (_LOOKUP, [(uid(2), "Class"), (uid(3), "Other")]),
    "instance_types": (_LOOKUP, [("ty1", "text")]),
    "modes_of_issuance": (_LOOKUP, [("mo1", "single")]),
    "instance_statuses": (_LOOKUP, [("s1", "cataloged")]),
}
