import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import brute
from conftest import ROWS
from shelfmark.llm import queries
from shelfmark.llm.line_dedup import PerfectHash, Shard, dedup_lines, distinct_rows, line_hashes, shard_of

WHITE = " \t\n\v\f\r"


def wanted(texts, min_docs=10, min_chars=1):
    """(text, n_lines, n_dropped) of each text."""
    lines = [(text or "").split("\n") for text in texts]
    keys = [[brute.lower(line.strip(WHITE)) for line in of] for of in lines]
    counts = Counter(key for of in keys for key in set(of))
    drop = {key for key, n in counts.items() if n >= min_docs and len(key) >= min_chars}
    kept = [[a for a, key in zip(*of, strict=True) if key not in drop] for of in zip(lines, keys, strict=True)]
    return [("\n".join(k), len(of), len(of) - len(k)) for k, of in zip(kept, lines, strict=True)]


def got(df):
    return sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect())


def random_texts(seed, count=200):
    rng = random.Random(seed)
    common = [f"Line {n} é" for n in range(12)]
    texts = []
    for _ in range(count):
        lines = [
            rng.choice(WHITE.replace("\n", "") + " ") + rng.choice(common).upper() if rng.random() < 0.3
            else f"own {rng.randrange(5000)}" if rng.random() < 0.9 else rng.choice(["", "  ", " "])
            for _ in range(rng.randrange(8))
        ]
        texts.append("\n".join(lines))
    return texts


@pytest.mark.parametrize("options", [
    {}, {"min_docs": 2, "shard_keys": 8, "round_bytes": 1}, {"min_docs": 3, "min_chars": 8, "shard_keys": 3},
    {"min_docs": 1, "shard_keys": 100, "round_bytes": 3000},
])
def test_random_texts(spark, options):
    texts = random_texts(len(options))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    limits = {k: v for k, v in options.items() if k.startswith("min")}
    want = [(n, *row) for n, row in enumerate(wanted(texts, **limits))]
    assert got(dedup_lines(docs, **options)) == want


def test_query_digests(spark, sf_small, texts):
    rows = queries.QUERIES["op11_line_dedup"](spark, sf_small).collect()
    want = {n: row for n, row in zip(texts, wanted(texts.values()), strict=True)}
    assert len(rows) == len(texts) and any(r.n_dropped for r in rows)
    for r in rows:
        text, lines, dropped = want[r.doc_id]
        assert (r.n_lines, r.n_dropped) == (lines, dropped)
        assert r.kept_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_edges(edge_docs, empty_docs):
    found = dedup_lines(edge_docs, min_docs=4)
    want = Counter((n, *row) for (n, _), row in zip(ROWS, wanted([t for _, t in ROWS], 4), strict=True))
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()) == want
    empty = dedup_lines(empty_docs)
    assert empty.columns == ["doc_id", "text", "n_lines", "n_dropped"] and empty.count() == 0


def test_a_line_counts_once_per_document(spark):
    docs = spark.createDataFrame([(1, "a\nA\n a"), (2, "a\nb")], "doc_id long, text string")
    assert got(dedup_lines(docs, min_docs=3)) == [(1, "a\nA\n a", 3, 0), (2, "a\nb", 2, 0)]
    assert got(dedup_lines(docs, min_docs=2)) == [(1, "", 3, 3), (2, "b", 2, 1)]


@pytest.mark.parametrize("count", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal(count):
    rng = np.random.default_rng(count)
    keys, _ = distinct_rows(rng.integers(0, 1 << 63, (count, 2)).astype(np.uint64))
    made = PerfectHash.build(keys)
    assert sorted(made.find(keys).tolist()) == list(range(count))
    shard = Shard.build(keys, np.arange(count) + 5)
    assert shard.count(keys).tolist() == list(range(5, count + 5))
    others = rng.integers(0, 1 << 63, (1000, 2)).astype(np.uint64)
    assert not shard.count(others).any()


def test_keys_and_shards():
    hashes = line_hashes([b" A b\r", b"a B", b"", b"\t ", b"\xc3\x89", b"\xc3\xa9"])
    assert (hashes[0] == hashes[1]).all() and not hashes[2:4].any() and (hashes[4] != hashes[5]).any()
    assert set(shard_of(hashes, 1)) == {0}
    many = line_hashes([str(n).encode() for n in range(3000)])
    assert set(shard_of(many, 7)) == set(range(7))
