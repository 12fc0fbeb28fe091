import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from conftest import ROWS
from shelfmark.llm import near_dup
from shelfmark.llm.common import components
from shelfmark.llm.shingles import byte_slices, shingle_sets
from shelfmark.llm.near_dup import (
    Settings, keep_one_of_each, linked_sets, near_duplicates, small_nodes, spanning,
)


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def wanted(texts, words, percent):
    found = brute.near_components(texts, words, percent)
    return {
        n: (len(brute.shingles(text, words)), found[n], found[n] == n) for n, text in texts.items()
    }


def test_documents(documents, texts):
    settings = Settings(words=3, percent=85)
    assert got(near_duplicates(documents, settings=settings)) == wanted(texts, 3, 85)


def chain(count, seed=5):
    """Copies of copies, each with a word or two changed, and texts on their own."""
    rng = random.Random(seed)
    texts = {0: " ".join(f"w{rng.randrange(4000)}" for _ in range(150))}
    for number in range(1, count):
        words = texts[rng.randrange(number)].split()
        for _ in range(rng.randrange(1, 3)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(4000)}"
        texts[number] = " ".join(words)
    for number in range(count, count + 20):
        texts[number] = " ".join(f"w{rng.randrange(4000)}" for _ in range(60))
    return texts


@pytest.mark.parametrize("small", [256, 12])
def test_a_large_group_of_near_copies(spark, small):
    """With small nodes and clusters the group goes the way of very large ones."""
    texts = chain(300)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    settings = Settings(words=3, percent=85, small_node=small, small_cluster=small)
    assert got(near_duplicates(docs, settings=settings)) == wanted(texts, 3, 85)


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])  # op10's and the pipeline's
def test_a_crowded_family_neither_branches_nor_gets_more_trees(spark, monkeypatch, words, percent):
    """Its rows would multiply by trees and levels; it is compared whole, at once."""
    rows = []
    for name in ("plant", "descend"):
        original = getattr(near_dup, name)

        def counted(*args, original=original):
            rows.append(original(*args).count())
            return original(*args)

        monkeypatch.setattr(near_dup, name, counted)
    base = [f"w{n}" for n in range(150)]
    texts = {n: " ".join([*base[: n % 150], f"own{n}", *base[n % 150 + 1 :]]) for n in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    settings = Settings(words=words, percent=percent, small_node=64, small_cluster=64)
    assert got(near_duplicates(docs, settings=settings)) == wanted(texts, words, percent)
    assert rows == [len(texts) * settings.trees]


def test_pairs_of_a_crowded_source_keep_meeting(spark):
    """Each source has one pair 86 % alike, all else there is less; its nodes get small at depth 15."""
    rng = np.random.default_rng(3)
    rows = []
    for source in range(40):
        base = rng.integers(0, 1 << 16, 128)
        for number in range(400):
            own = rng.random(128) >= (0.925 if number < 2 else 0.85)
            tokens = np.where(own, rng.integers(0, 1 << 16, 128), base).astype(np.uint16)
            rows.append((source * 1000 + number, 100, tokens.tobytes()))
    reps = spark.createDataFrame(rows, "rep long, n long, tokens binary")
    groups = small_nodes(reps, Settings(percent=85, small_node=32))[0].select("members").collect()
    met = {a for r in groups for a in r.members if a % 1000 == 0 and a + 1 in r.members}
    assert len(met) >= 39


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_documents_that_never_part_are_compared_block_by_block(spark, broadcast_rows):
    texts = chain(120)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    settings = Settings(
        words=3, percent=85, small_node=20, small_cluster=20, max_depth=1, first_depth=1,
        broadcast_rows=broadcast_rows,
    )
    assert got(near_duplicates(docs, settings=settings)) == wanted(texts, 3, 85)


def test_blocks_of_many_families(spark):
    """One node that never parts, of small families that only blocks against blocks bring together."""
    rng = random.Random(9)
    texts = {}
    for family in range(150):
        base = [f"w{rng.randrange(4000)}" for _ in range(120)]
        for member in range(3):
            words = list(base)
            words[rng.randrange(120)] = f"m{member}"
            texts[len(texts)] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    settings = Settings(
        words=3, percent=85, small_node=40, trees=1, more_trees=0, max_depth=0, first_depth=0,
    )
    assert got(near_duplicates(docs, settings=settings)) == wanted(texts, 3, 85)


def test_a_large_batch_is_hashed_in_slices():
    """What is held while a batch of long texts is shingled does not grow with the batch."""
    import tracemalloc

    def peak(texts):
        batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
        tracemalloc.start()
        for part in byte_slices(batch, 0, 1 << 18):
            for _ in shingle_sets(part.column(0), 3):
                pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    text = " ".join(f"w{i}" for i in range(9_000))
    peak([text])  # tables that are kept
    assert peak([text] * 200) < 1.2 * peak([text] * 20)


def test_edges(edge_docs, empty_docs):
    rows = near_duplicates(edge_docs, settings=Settings(words=3, percent=85)).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    for number in (1, 2, 3):
        assert (by_id[number].n_shingles, by_id[number].component_id) == (0, number)
    assert by_id[4].n_shingles == by_id[5].n_shingles == 1
    assert [r.component_id for r in rows if r.n_shingles == 10] == [6] * 5
    single = {n: t or "" for n, t in ROWS if n is not None}
    assert {n: by_id[n].n_shingles for n in single} == {
        n: len(brute.shingles(t, 3)) for n, t in single.items()
    }
    assert near_duplicates(empty_docs).count() == 0


def test_keep_one_of_each(edge_docs, empty_docs):
    kept = keep_one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 6 in ids and not {7, 8} & set(ids) and ids.count(None) == 2
    assert keep_one_of_each(empty_docs).count() == 0


@pytest.mark.parametrize("words", [1, 3, 5])
@pytest.mark.parametrize("texts", [[""], ["a"], ["", "a b", ""], ["a b c d e f", "x"], ["A b", "a B"], ["é 日 é 日 é 日"]])
def test_shingles_of_small_batches(words, texts):
    column = pa.array(["skipped", *texts], pa.string()).slice(1)
    sets = list(shingle_sets(column, words))
    assert [len(s) for s in sets] == [len(brute.shingles(t, words)) for t in texts]
    assert len({s.tobytes() for s in sets}) == len({brute.shingles(t, words) for t in texts})


def test_linked_sets_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        base = rng.integers(0, 1 << 60, 40).astype(np.uint64)
        sets = [np.unique(np.concatenate([base[rng.random(40) < 0.95], rng.integers(0, 1 << 60, 2).astype(np.uint64)]))
                for _ in range(rng.integers(2, 8))]
        linked = linked_sets(sets, 85)
        for a in range(len(sets)):
            for b in range(len(sets)):
                common = len(np.intersect1d(sets[a], sets[b]))
                whole = len(np.union1d(sets[a], sets[b]))
                assert a == b or linked[a, b] == (100 * common >= 85 * whole)


def test_spanning_pairs_connect_the_same():
    adjacent = np.zeros((7, 7), bool)
    for a, b in [(0, 3), (3, 5), (1, 2), (6, 6)]:
        adjacent[a, b] = adjacent[b, a] = True
    assert sorted(spanning(adjacent)) == [(0, 3), (0, 5), (1, 2)]
    assert spanning(np.zeros((0, 0), bool)) == []


@pytest.mark.parametrize("limits", [{}, {"forest_edges": 100}, {"forest_edges": 30, "broadcast_rows": 10**6}])
def test_components_against_union_find(spark, limits):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(50)] + [(5, 5)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), **limits).collect()}
    nodes = sorted({n for a, b in edges if a != b for n in (a, b)})
    place = {n: i for i, n in enumerate(nodes)}
    parent = list(range(len(nodes)))
    for _ in nodes:
        for a, b in edges:
            if a != b:
                low = min(parent[place[a]], parent[place[b]])
                parent[place[a]] = parent[place[b]] = low
    assert found == {n: nodes[parent[place[n]]] for n in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(3, 3)], "a long, b long").where(F.lit(True))).count() == 0
