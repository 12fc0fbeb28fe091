"""Form values, text toggles, code lists, table registry."""

import datetime as dt

import pytest

from shelfmark import REPORTS, Tables, run_report
from shelfmark.functions import as_boolean, compose_call_number, normalise_code, parse_code_list
from shelfmark.operators import conform, is_on
from small_library import tables


@pytest.fixture(scope="module")
def library(spark):
    return tables(spark)


@pytest.mark.parametrize("text, on", [
    ("1", True), (" Yes ", True), ("ON", True), ("t", True), ("0", False), ("", False),
    (None, False), ("yess", False), (True, True), (False, False),
])
def test_toggle(text, on):
    assert is_on(text) is on


@pytest.mark.parametrize("text, codes", [
    ("cs101 ,Hist 200", ["CS 101", "HIST 200"]), ("CS101A2", ["CS 101A 2"]), ("   ", []),
    ("a,", ["A", ""]), (" , b", ["", "B"]), ("x  1", ["X  1"]),
])
def test_code_list(text, codes):
    assert parse_code_list(text) == codes


def test_codes_are_normalised_alike(spark):
    texts = ["cs101", " CS 101 ", "CS101A2", "a1b22c3", "9a9", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(normalise_code(df.t)).collect()]
    assert got == [None if t is None else ",".join(parse_code_list(t)) for t in texts]


def test_booleans(spark):
    words = {" True": True, "on": True, "Y": True, "1": True, "OFF": False, "of": False, "o": None,
             "2": None, None: None}
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in df.select(as_boolean(df.w)).collect()] == list(words.values())


def test_missing_parts_leave_their_space(spark):
    df = spark.createDataFrame([(None, "a", None, "b"), (None, None, None, None)], "w string, x string, y string, z string")
    got = [r[0] for r in df.select(compose_call_number(df.w, df.x, df.y, df.z)).collect()]
    assert got == ["a  b", ""]


def test_conform_goes_by_position(spark):
    df = spark.range(1).selectExpr("id as a", "'2' as a")
    assert conform(df, [("x", "string"), ("y", "int")]).collect()[0].asDict() == {"x": "0", "y": 2}
    with pytest.raises(ValueError):
        conform(df, [("x", "string")])


class TestReports:
    def test_every_report_is_there(self):
        assert len(REPORTS) == 14

    def test_values_are_bound(self):
        bound = REPORTS["reserves_quarter"].bind(
            {"TERM_NAME": "Winter", "start_date": dt.date(2024, 1, 2), "end_date": " "}
        )
        assert bound == {"term_name": "Winter", "start_date": "2024-01-02"}

    def test_names_ignore_case(self, library):
        df = run_report("circ_stats_course_reserves", library, {"Circ_Stat_Course_Name": "intro"})
        assert df.count() == 2

    @pytest.mark.parametrize("report, values", [
        ("circulation_history", {}), ("circulation_history", {"barcode_to_check": ""}),
        ("reserves_quarter_course", {"term_name": "Winter"}), ("item_ext", {"x": "1"}),
        ("reserves_quarter", {"start_date": "02/01/2024"}),
    ])
    def test_bad_values(self, report, values):
        with pytest.raises(ValueError):
            REPORTS[report].bind(values)

    def test_unknown_report(self, library):
        with pytest.raises(KeyError):
            run_report("nope", library)


class TestTables:
    def test_unknown_and_missing(self, spark, library):
        with pytest.raises(KeyError):
            Tables({"nope": spark.range(1)})
        with pytest.raises(KeyError):
            Tables({})["courses"]
        with pytest.raises(ValueError):
            Tables({"courses": spark.range(1)})["courses"]

    def test_opened_on_first_use(self, library):
        opened = []

        def courses():
            opened.append(1)
            return library["courses"]

        registry = Tables({"courses": courses})
        assert opened == []
        assert registry["courses"] is registry["courses"]
        assert opened == [1]

    def test_parquet_folder(self, spark, library, tmp_path):
        library["terms"].write.parquet(f"{tmp_path}/t")
        assert Tables.from_parquet(spark, str(tmp_path), {"terms": "t"})["terms"].count() == 4

    def test_catalog_table(self, spark, library):
        library["terms"].createOrReplaceTempView("my_terms")
        assert Tables.from_catalog(spark, {"terms": "my_terms"})["terms"].count() == 4
