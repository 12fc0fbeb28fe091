import hashlib
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import ROWS
from shelfmark.llm import simhash


def bits(a, b):
    return bin(int(a, 16) ^ int(b, 16)).count("1")


def votes(text):
    """The fingerprint of a text, vote by vote."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text) or [""]
    tally = [0] * simhash.BITS
    for word, after in zip(words, words[1:] + [None], strict=True):
        first = xxhash.xxh64_intdigest(word.encode(), 42)
        if after is not None:
            first = xxhash.xxh64_intdigest(after.encode(), first)
        second = xxhash.xxh64_intdigest(struct.pack("<Q", first), 42)
        for place, hashed in enumerate((first, second)):
            for bit in range(64):
                tally[64 * place + bit] += (len(word) + len(after or "")) * (1 if hashed >> bit & 1 else -1)
    return "".join(
        f"{sum(1 << bit for bit in range(64) if tally[64 * place + bit] > 0):016x}" for place in (0, 1)
    )


def check(rows, texts):
    """Edited digests and likenesses of documents with distinct ids."""
    order = sorted(texts)
    prints = {r.doc_id: r for r in rows}
    for place, number in enumerate(order):
        after = order[(place + 1) % len(order)]
        text, quarter, row = texts[number], len(texts[number]) // 4, prints[number]
        edited = text[: len(text) - quarter] + texts[after][:quarter]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.near_edited == 1 - bits(row.fingerprint, row.edited_fingerprint) / simhash.BITS
        assert row.near_next == 1 - bits(row.fingerprint, prints[after].fingerprint) / simhash.BITS


def test_documents(documents, texts):
    rows = simhash.fingerprint_documents(documents).collect()
    check(rows, texts)
    assert {r.doc_id: r.fingerprint for r in rows} == {n: votes(text) for n, text in texts.items()}
    prints = sorted({r.fingerprint for r in rows})
    near = {p: sum(0 < bits(p, other) <= simhash.RADIUS for other in prints) for p in prints}
    assert {r.fingerprint: r.near_links for r in rows} == near
    assert sum(r.near_edited > r.near_next for r in rows) > 0.95 * len(rows)


def test_ranges_meet(spark):
    texts = {number * number: f"text {number} " * (number % 9) for number in range(200)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    nexts = simhash.with_next(docs, "doc_id", F.xxhash64("text"), "doc_id", rows_per_range=7)
    order = sorted(texts)
    got = {r.doc_id: r._next for r in nexts.collect()}
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def test_edges(spark, edge_docs, empty_docs):
    rows = simhash.fingerprint_documents(edge_docs).collect()
    assert len(rows) == len(ROWS)
    single = {number: text or "" for number, text in ROWS if number not in (None, 7)}
    by_id = {r.doc_id: r for r in rows if r.doc_id in single}
    assert {n: r.n_chars for n, r in by_id.items()} == {n: len(t) for n, t in single.items()}
    assert by_id[1].fingerprint == by_id[2].fingerprint == by_id[3].fingerprint == "0" * 32
    assert by_id[6].fingerprint in {r.fingerprint for r in rows if r.doc_id == 7}
    assert simhash.fingerprint_documents(empty_docs).count() == 0
    one = spark.createDataFrame([(5, "just one text of words")], "doc_id long, text string")
    assert simhash.fingerprint_documents(one).first().near_next == 1.0


@pytest.mark.parametrize(("radius", "blocks"), [(3, 6), (3, 4), (2, 7), (1, 2)])
def test_all_pairs_within_the_radius_are_found(spark, radius, blocks):
    import random

    random.seed(3)
    base = [random.getrandbits(128) for _ in range(40)]
    prints = set(base)
    for value in base:
        for flips in (1, 2, 3, 4):
            for _ in range(3):
                prints.add(value ^ sum(1 << bit for bit in random.sample(range(128), flips)))
    texts = [f"{value:032x}" for value in prints]
    df = spark.createDataFrame([(t,) for t in texts] * 2 + [(None,)], "fingerprint string")
    pairs = [(r.a, r.b) for r in simhash.pairs_within(df, radius, blocks).collect()]
    assert len(pairs) == len(set(pairs))
    got = {(r.a, r.b): r.distance for r in simhash.pairs_within(df, radius, blocks).collect()}
    want = {(a, b): bits(a, b) for a in texts for b in texts if a < b and bits(a, b) <= radius}
    assert got == want
    counts = {r.fingerprint: r.near_links for r in simhash.within_radius(df, radius, blocks).collect()}
    assert sum(counts.values()) == 2 * len(want)
