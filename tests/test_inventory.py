"""Inventory reports and wide tables on the small library."""

import datetime as dt

import pytest

from shelfmark import plans
from shelfmark.functions import as_uuid
from shelfmark.operators import item_notes
from small_library import tables, uid


@pytest.fixture(scope="module")
def library(spark):
    return tables(spark)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_patterns_ignore_case_beyond_ascii(spark, library):
    notes = spark.createDataFrame([("i1", "\u00c9tude")], "item_id string, note string")
    df = plans.class_list(library.with_tables(item_notes=notes), "\u00e9tude")
    assert [r.item_note for r in df.collect()] == ["\u00c9tude"]


def one(df, **where):
    found = [r for r in df.collect() if all(r[k] == v for k, v in where.items())]
    assert len(found) == 1
    return found[0]


class TestClassList:
    CALL = "Ref QA 1 QA 1  c1"

    def test_case_and_missing_parts(self, library):
        df = plans.class_list(library, "LATIN")
        assert sorted(rows(df)) == [
            ("B1", "STK", "Stacks", self.CALL, "Latin", "Class of Latin"),
            ("B1", "STK", "Stacks", self.CALL, "Latin", "latin again"),
        ]
        assert df.dtypes == list(plans.inventory.CLASS_LIST_SCHEMA)

    def test_suffix_on_request(self, library):
        df = plans.class_list(library, "^class", fix_duplicate=True)
        assert [r.item_call_number for r in df.collect()] == ["Ref QA 1 x  c1"]

    def test_no_pattern_no_rows(self, library):
        assert rows(plans.class_list(library)) == []

    def test_registered_tables_give_the_same(self, library):
        stored = library.with_tables(
            item_ext=plans.item_ext(library), item_notes=item_notes(library),
            instance_ext=plans.instance_ext(library),
        )
        assert rows(plans.class_list(stored, "a")) == rows(plans.class_list(library, "a")) != []
        both = [sorted(map(str, rows(plans.reserves_quarter(t)))) for t in (stored, library)]
        assert both[0] == both[1]


    def test_a_narrow_registered_table(self, library):
        narrow = plans.item_ext(library).drop("effective_call_number_suffix")
        stored = library.with_tables(item_ext=narrow)
        assert rows(plans.class_list(stored, "a")) == rows(plans.class_list(library, "a"))
        with pytest.raises(ValueError, match="effective_call_number_suffix"):
            plans.class_list(stored, "a", fix_duplicate=True)


def test_derived_tables_are_built_whatever_is_registered(library):
    stale = library.with_tables(
        item_ext=plans.item_ext(library).limit(1),
        instance_ext=plans.instance_ext(library).limit(0).select("instance_id", "title"),
    )
    assert sorted(map(str, rows(plans.item_ext(stale)))) == sorted(map(str, rows(plans.item_ext(library))))
    assert rows(plans.instance_ext(stale)) == rows(plans.instance_ext(library))


@pytest.mark.parametrize("text, value", [
    (uid(7), uid(7).lower()), (" {" + uid(7) + "}", uid(7).lower()),
    (uid(7).replace("-", ""), uid(7).lower()), ("not a uuid", None), (uid(7) + "0", None),
    ("", None), (None, None), (uid(7).replace("A", "G"), None),
])
def test_ids_are_validated(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(as_uuid(df.t)).first()[0] == value


def test_ids_match_in_any_case_in_every_table(spark):
    from small_library import _TABLES
    from shelfmark.sources.tables import is_id

    def shouted(name):
        schema, given = _TABLES[name]
        kinds = [part.split() for part in schema.split(", ")]
        return [tuple(
            v.upper() if isinstance(v, str) and kind == "string" and is_id(column) else v
            for v, (column, kind) in zip(row, kinds, strict=True)
        ) for row in given]

    plain, loud = tables(spark), tables(spark, **{name: shouted(name) for name in _TABLES})
    for build in (
        plans.item_ext, plans.instance_ext, plans.reserves_quarter, plans.internal_use_by_item,
        lambda t: plans.note_type_items(t, uid(2)), lambda t: plans.class_list(t, "a"),
        lambda t: plans.zero_use_items(t, location_id="LOC1"),
        lambda t: plans.collection_inventory(t, "Curr"),
    ):
        got, want = (sorted(map(str, rows(build(t)))) for t in (loud, plain))
        assert got == want != []


def test_collection_lists_primary_contributors_once(library):
    df = plans.collection_inventory(library, "Curr", link_base="https://x/")
    assert rows(df) == [(
        "Stacks", "latin", "Ada", "Curr QA 1", "v1", "c1", "https://x/b1234567", "B1", "i1", "h1",
    )]
    assert rows(plans.collection_inventory(library, "curr")) == []


def test_note_type_ids_match_in_any_case(library):
    df = plans.note_type_items(library, uid(2))
    shared = ("true", "it1", "ho1", "Stacks", "B1", '["a", "b"]', "QA 1", "QA 11", "book", "Latin", "Class")
    assert rows(df) == [
        (*shared, "Class of Latin", "false", 1), (*shared, "latin again", None, 3),
    ]
    assert df.dtypes == list(plans.inventory.NOTE_TYPE_SCHEMA)
    assert rows(plans.note_type_items(library, uid(2).lower())) == rows(df)


def test_default_note_type(library):
    assert rows(plans.note_type_items(library)) == []


def test_circulation_notes_keep_their_order(library):
    df = plans.item_circulation_notes(library)
    assert rows(df) == [
        ("i1", uid(4).lower(), "handle", "Check in", True, 1), ("i1", None, None, "Check out", False, 2),
    ]
    assert df.dtypes == list(plans.derived.CIRCULATION_NOTES_SCHEMA)


def test_wide_items(library):
    df = plans.item_ext(library)
    assert df.count() == 3 and len(df.columns) == 43
    full = one(df, item_id="i1")
    assert (full.item_hrid, full.volume, full.number_of_pieces) == ("it1", None, "3")
    assert full.discovery_suppress is True  # "on"
    assert (full.damaged_status_id, full.damaged_status_name) == (uid(1).lower(), "torn")
    assert (full.permanent_loan_type_name, full.temporary_loan_type_name) == ("long", None)
    assert full.created_date == dt.datetime(2020, 1, 1)
    second = one(df, item_id="i2")
    assert second.effective_call_number is None and second.discovery_suppress is None
    assert (second.material_type_id, second.material_type_name) == ("m9", None)
    assert (second.permanent_location_name, second.temporary_location_name) == ("Stacks", "Annex")
    bare = one(df, item_id="i3")
    assert (bare.item_hrid, bare.volume) == (None, "v3")


def test_wide_instances(library):
    df = plans.instance_ext(library)
    assert df.count() == 2 and len(df.columns) == 22
    full = one(df, instance_id="n1")
    assert (full.previously_held, full.staff_suppress, full.is_bound_with) == (False, False, True)
    assert full.cataloged_date == dt.date(2020, 2, 3)
    assert full.updated_date == dt.datetime(2023, 12, 31, 23, 0)
    created = df.selectExpr("instance_id", "cast(record_created_date as string) as c")
    assert one(created, instance_id="n1").c == "2023-12-31 23:00:00"
    assert (full.updated_by_user_id, full.match_key) == (uid(5).lower(), None)
    assert (full.type_name, full.mode_of_issuance_name, full.status_name) == ("text", "single", "cataloged")
    bare = one(df, instance_id="n2")
    assert (bare.previously_held, bare.discovery_suppress, bare.is_bound_with) == (True, False, False)
    assert bare.record_created_date is None


def test_items_without_notes_give_none(library):
    assert {r.item_id for r in item_notes(library).collect()} == {"i1"}
