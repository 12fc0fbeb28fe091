"""What Spark runs: join kinds, pruning, pushed filters, hot keys."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import fixtures
from shelfmark import Tables, plans, store_lower_ids
from shelfmark.operators import (
    Window, count_checkouts, count_checkouts_per_window, date_literal, skew_join, term_window,
)

QUERIES = {name: query for name, query in entry.queries().items() if name in entry.QUERIES}


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df) -> str:
    """The final plan, after running it."""
    df.collect()
    return planned(df).split("\n+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(name, spark, sf_small):
    plan = planned(QUERIES[name](spark, sf_small))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "ArrowEval"):
        assert node not in plan


@pytest.fixture
def no_broadcast(spark):
    """Settings under which small test data is joined and split the way large data is."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, rows: int, column: str):
    """A third of the rows on key 7, the others spread over a thousand keys."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("string")
    return spark.range(0, rows, 1, 8).select(key.alias(column), F.col("id").alias("row"))


def test_hot_key_is_split_against_a_grouped_side(spark, no_broadcast):
    rows = hot(spark, 200_000, "k")
    grouped = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = skew_join(rows, grouped, ["k"]).agg(F.sum("n"), F.count("row"))
    plan = ran(joined)
    assert "skew=true" in plan
    others = (200_000 - 66_667)
    total, count = joined.collect()[0]
    assert count == 200_000
    counts = {r.k: r.n for r in grouped.collect()}
    assert sum(counts.values()) == others + 66_667
    assert total == sum(n * n for n in counts.values())


def test_hot_item_and_course_of_a_report_are_split(spark, no_broadcast):
    """One item on a third of all reserves, and one course number on a third of courses."""
    small = fixtures.library(spark, "/root/testdata/sf0.001")
    n = 30_000
    ids = spark.range(0, n, 1, 8)
    number = F.when(F.col("id") % 3 == 0, "POP").otherwise(F.concat(F.lit("C"), F.col("id") % 500))
    prefix = fixtures.key(0)[:-12]
    item = F.concat(F.lit(prefix), F.lpad(
        F.when(F.col("id") % 3 == 1, "7").otherwise((F.col("id") % 190).cast("string")), 12, "0"
    ))
    listing = F.concat(F.lit("listing "), F.sha2(F.col("id").cast("string"), 256))
    library = small.with_tables(
        courses=ids.select(
            listing.alias("course_listing_id"), number.alias("course_number"),
            F.lit("x").alias("name"),
        ),
        course_listings=ids.where("id % 5 > 0").select(
            listing.alias("id"),
            F.concat(F.lit(prefix), F.lpad((F.col("id") % 25).cast("string"), 12, "0")).alias("term_id"),
        ),
        reserves=ids.select(
            listing.alias("course_listing_id"), item.alias("item_id"),
            F.lit(None).cast("date").alias("start_date"),
            F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("__current"),
        ),
    )
    df = plans.reserves_quarter(library)
    plan = ran(df)
    split = re.findall(r"SortMergeJoin\(skew=true\) \[(\w+)#", plan)
    assert {"course_number", "item_id"} <= set(split)
    assert df.count() == n


def test_sort_cuts_one_term_into_ranges(spark, no_broadcast, tmp_path):
    """All rows share the sort key's first column; the ties keep the ranges even."""
    rows = hot(spark, 50_000, "k").withColumn("term", F.lit("Permanent"))
    df = plans.reserves.ordered(rows.select("term", "k", "row"), ["term"])
    df.write.parquet(f"{tmp_path}/sorted")
    files = spark.read.parquet(f"{tmp_path}/sorted").groupBy(F.input_file_name()).count()
    sizes = [r["count"] for r in files.collect()]
    assert sum(sizes) == 50_000
    assert len(sizes) > 1 and max(sizes) < 50_000 * 0.6


@pytest.fixture(scope="module")
def stored_loans(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("loans"))
    loans = spark.range(20_000).select(
        F.col("id").alias("__id"), (F.col("id") % 50).cast("string").alias("item_id"),
        F.lit("checkedout").alias("action"), F.lit("note").alias("unused"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60)).alias("loan_date"),
    )
    loans.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_loan_scan_reads_few_columns_and_pushes_dates(spark, stored_loans):
    window = Window(date_literal("2023-11-15"), date_literal("2023-11-16"))
    plan = planned(count_checkouts(stored_loans, window))
    scan = re.search(r"FileScan parquet \[(.*?)\]", plan).group(1)
    assert "unused" not in scan
    pushed = re.search(r"PushedFilters: \[(.*)", plan).group(1)
    assert "GreaterThanOrEqual(loan_date" in pushed and "EqualTo(action,checkedout)" in pushed


def test_named_term_reaches_the_scan(spark, stored_loans):
    """A term's dates come from a subquery and still cut the scan."""
    terms = spark.createDataFrame(
        [("a", "Fall", dt.date(2023, 11, 15), dt.date(2023, 11, 16))],
        "id string, name string, start_date date, end_date date",
    )
    df = count_checkouts(stored_loans, term_window(terms, "Fall", "0001-01-01", "9999-12-31"))
    assert sum(r.checkouts for r in df.collect()) == 1440
    plan = planned(df)
    filters = re.search(r"DataFilters: \[(.*?)\], Format", plan).group(1)
    assert "loan_date" in filters and "subquery" in filters.lower()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_building_a_report_runs_no_job(name, spark, sf_small):
    context = spark.sparkContext
    context.setJobGroup(f"build {name}", "")
    try:
        QUERIES[name](spark, sf_small)
        assert len(context.statusTracker().getJobIdsForGroup(f"build {name}")) == 0
    finally:
        context.setJobGroup("", "")


def test_hot_instance_of_an_inventory_is_split_in_both_joins(spark, no_broadcast):
    """Half of the items under one instance; contributors are joined by the same key."""
    n = 60_000
    ids = spark.range(0, n, 1, 8)
    instance = F.when(F.col("id") % 2 == 0, "n7").otherwise(F.concat(F.lit("n"), F.col("id") % 900))
    library = fixtures.library(spark, "/root/testdata/sf0.001").with_tables(
        items=ids.select(
            F.concat(F.lit("i"), "id").alias("id"), F.lit("it").alias("hrid"),
            F.lit("b").alias("barcode"), F.lit("e").alias("enumeration"), F.lit("v").alias("volume"),
            F.lit("c").alias("copy_number"), F.concat(F.lit("h"), "id").alias("holdings_record_id"),
            F.lit("l").alias("effective_location_id"),
        ),
        holdings=ids.select(
            F.concat(F.lit("h"), "id").alias("id"), F.lit("ho").alias("hrid"),
            F.lit("Curr").alias("call_number_prefix"), F.lit("QA").alias("call_number"),
            instance.alias("instance_id"),
        ),
        instances=fixtures.library(spark, "/root/testdata/sf0.001")["instances"].limit(0).unionByName(
            spark.range(900).select(F.concat(F.lit("n"), "id").alias("id")), allowMissingColumns=True
        ),
        instance_contributors=spark.range(900).select(
            F.concat(F.lit("n"), "id").alias("instance_id"), F.lit("Ada").alias("contributor_name"),
            F.lit(True).alias("contributor_is_primary"),
        ),
    )
    df = plans.collection_inventory(library, "Curr")
    plan = ran(df)
    assert len(re.findall(r"SortMergeJoin\(skew=true\) \[instance_id#", plan)) == 2
    assert df.count() == n


def test_loans_cross_the_network_once_for_all_windows(spark, stored_loans):
    windows = spark.createDataFrame(
        [(dt.date(2023, 11, 15), dt.date(2023, 11, 16)), (dt.date(2023, 11, 15), dt.date(2023, 11, 20))],
        "window_start date, window_end date",
    )
    df = count_checkouts_per_window(stored_loans, windows)
    assert sum(r.checkouts for r in df.collect()) > 1440
    plan = ran(df).split("Subquery")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "NestedLoop" not in plan


def test_items_are_cut_to_reserves_before_their_titles(spark, sf_small, no_broadcast):
    """Item records are shuffled by item, holdings, result group and item: four times."""
    plan = ran(QUERIES["reserves_quarter_dates"](spark, sf_small))
    lines = plan.split("\n")
    record = next(i for i, line in enumerate(lines) if "FileScan parquet [p_partkey" in line and "p_brand" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above, level = [], depth(lines[record])
    for line in reversed(lines[:record]):
        if depth(line) < level:
            level = depth(line)
            above.append(line)
    shuffles = [line for line in above if re.search(r"Exchange hashpartitioning", line)]
    assert len(shuffles) <= 4, shuffles


def test_loans_are_scanned_once_per_report(spark, sf_small):
    plan = ran(QUERIES["reserves_quarter_course_history"](spark, sf_small))
    assert plan.count("FileScan parquet [l_") == 1


@pytest.mark.parametrize("name, table, most", [
    ("circulation_history", "p_partkey", 2),  # two versions of each item
    ("internal_use_count", "p_partkey", 2),
    ("reserves_quarter_term", "o_orderkey", 2),  # the reserves, and their items alone
])
def test_tables_are_scanned_no_more_than_needed(name, table, most, spark, sf_small):
    assert ran(QUERIES[name](spark, sf_small)).count(f"FileScan parquet [{table}") <= most


@pytest.mark.parametrize("name, parses", [
    ("item_ext", 1), ("instance_ext", 1), ("item_circulation_notes", 1), ("note_type_items", 1),
    ("class_list", 2),  # the notes of all items, the other fields of those that match
])
def test_documents_are_parsed_once(name, parses, spark, sf_small):
    assert ran(QUERIES[name](spark, sf_small)).count("from_json(") == parses


def test_course_codes_cut_the_reserves(spark, sf_small, no_broadcast):
    """The reserves are cut to the chosen courses' listings before anything else."""
    plan = ran(QUERIES["reserves_permanent_codes"](spark, sf_small))
    assert re.search(r"\[course_listing_id#\d+\], \[course_listing_id#\d+\], LeftSemi", plan)


ITEM = "00000000-0000-0000-0000-00000000000a"


def test_ids_stored_in_lower_case_reach_the_files(spark, tmp_path):
    """A filter on a marked or named id is pushed to the scan; one on other ids is not."""
    rows = spark.createDataFrame([(ITEM.upper(), "n")], "id string, name string")
    rows.write.parquet(str(tmp_path / "plain" / "locations"))
    store_lower_ids(rows).write.parquet(str(tmp_path / "marked" / "locations"))

    def pushed(tables):
        found = tables["locations"].where(F.col("id") == ITEM)
        return f"EqualTo(id,{ITEM})" in planned(found), found.count()

    plain, marked = str(tmp_path / "plain"), str(tmp_path / "marked")
    assert pushed(Tables.from_parquet(spark, plain, ["locations"])) == (False, 1)
    assert pushed(Tables.from_parquet(spark, marked, ["locations"])) == (True, 1)
    for options in ({"lower_ids": False}, {"stored_lower": ["locations"]}, {"stored_lower": ["locations.id"]}):
        assert pushed(Tables.from_parquet(spark, marked, ["locations"], **options)) == (True, 1)
    with pytest.raises(KeyError):
        Tables.from_parquet(spark, plain, ["locations"], stored_lower=["no_such_table.id"])


def test_bucketed_ids_join_without_a_shuffle(spark, tmp_path):
    ids = [(f"{n:08x}-0000-0000-0000-00000000000A", n) for n in range(50)]
    holdings = spark.createDataFrame([(i, "h", None, "c", i) for i, _ in ids], "id string, hrid string, call_number_prefix string, call_number string, instance_id string")
    history = spark.createDataFrame([(i, f"title {n}") for i, n in ids], "id string, title string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df, key in (("b_holdings", holdings, "instance_id"), ("b_history", history, "id")):
            store_lower_ids(df).write.bucketBy(4, key).sortBy(key).mode("overwrite").saveAsTable(name)
        tables = Tables.from_catalog(spark, {"holdings": "b_holdings", "instance_history": "b_history"})
        titles = tables["instance_history"].withColumnRenamed("id", "instance_id")
        joined = tables["holdings"].join(titles, "instance_id")
        assert "Exchange" not in planned(joined) and joined.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("b_holdings", "b_history"):
            spark.sql(f"drop table if exists {name}")


def test_windows_are_found_by_binary_search(spark):
    """One pass over loans: no filter over the array of all windows, counts before windows."""
    loans = spark.createDataFrame([("1", "i", "checkedout", None)], "__id string, item_id string, action string, loan_date timestamp")
    windows = spark.sql("select date '2024-01-01' as window_start, date '2024-02-01' as window_end")
    plan = planned(count_checkouts_per_window(loans, windows))
    loan_side = plan[plan.index("_interval"):]
    assert "aggregate(" in loan_side and "Join" not in plan
