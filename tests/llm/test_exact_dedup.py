import hashlib

import pytest
from pyspark.sql import functions as F

from brute import lower
from conftest import ROWS
from shelfmark.llm.exact_dedup import exact_duplicates, keep_one_copy, text_digest


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_edges_against_brute_force(edge_docs, broadcast_rows):
    digest = text_digest(F.col("text"))
    rows = exact_duplicates(edge_docs, carry={"sha": digest}, broadcast_rows=broadcast_rows).collect()
    groups = {}
    for number, text in ROWS:
        groups.setdefault(lower(text or ""), []).append(number)
    assert len(rows) == len(ROWS)
    shas = {hashlib.sha256(text.encode()).hexdigest(): text for text in groups}
    for row in rows:
        members = groups[shas[row.sha]]
        assert row.group_size == len(members)
        assert row.keep_id == max((n for n in members if n is not None), default=None)
    kept = [shas[row.sha] for row in rows if row.kept]
    assert sorted(kept) == sorted(groups)


def test_prefix_is_refined_by_the_whole_text(spark):
    texts = ["p" * 200 + "a", "p" * 200 + "b", "p" * 200 + "A", "q" * 201]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_duplicates(docs).collect()}
    assert rows == {0: (2, 2, False), 1: (1, 1, True), 2: (2, 2, True), 3: (3, 1, True)}


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_keep_one_copy_keeps_columns_and_one_of_each(edge_docs, empty_docs, broadcast_rows):
    kept = keep_one_copy(edge_docs, broadcast_rows=broadcast_rows)
    assert kept.columns == edge_docs.columns
    texts = [lower(row.text or "") for row in kept.collect()]
    assert sorted(texts) == sorted({lower(text or "") for _, text in ROWS})
    assert keep_one_copy(empty_docs).count() == 0
    assert exact_duplicates(empty_docs).count() == 0


@pytest.mark.parametrize("share", [0.34])
def test_a_hot_group(spark, share):
    docs = spark.range(0, 9_000, 1, 8).select(
        F.col("id").alias("doc_id"),
        F.when(F.rand(1) < share, "hot text").otherwise(F.concat(F.lit("cold "), "id")).alias("text"),
    )
    rows = exact_duplicates(docs)
    hot = docs.where("text = 'hot text'")
    row = rows.where("group_size > 1").agg(
        F.count("*").alias("n"), F.min("keep_id").alias("low"), F.max("keep_id").alias("high"),
        F.sum(F.col("kept").cast("int")).alias("kept"),
    ).first()
    assert row.n == hot.count() and row.low == row.high == hot.agg(F.max("doc_id")).first()[0]
    assert row.kept == 1
