import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import queries
from shelfmark.llm.prefix_trie import prefix_trie
from shelfmark.llm.scan import contract, rank_list, running

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
)


def rebuilt(rows):
    convs = defaultdict(list)
    for number, turn, role, text in rows:
        if number is not None:
            convs[number].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {n: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for n, ts in convs.items()}
    out = {}
    for n in turns:
        h = zlib.crc32(str(n).encode()) % 4
        out[n] = tuple(turns.get(n - n % 20, [])[:h] + turns[n][h:])
    return out


def wanted(rows):
    whole = rebuilt(rows)
    members = defaultdict(list)
    for n, turns in whole.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(n)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in children[node])
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
    return sorted((
        min(members[node]), len(node), -1 if not node else min(members[node[:-1]]),
        len(members[node]), len(children[node]), leaves[node], saved[node],
        hashlib.sha256(",".join(map(str, sorted(n for n in members[node] if whole[n] == node))).encode()).hexdigest(),
    ) for node in members)


def got(df):
    assert tuple(df.columns) == COLUMNS
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *r[3:]) for r in df.collect())


def random_conversations(seed, count=90):
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        if n % 20 == 0 and rng.random() < 0.3:
            continue  # a base that isn't there
        number = n if n < count - 4 else n * 1_000_003
        turns = rng.sample(range(50), rng.choice([1, 2, 3, 5, 9]))
        rows += [(number, t, rng.choice(["user", "bot", None]), rng.choice(["a b", "c", "", None, "d  e\tf"])) for t in turns]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rows = random_conversations(seed)
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(prefix_trie(table, block=16)) == wanted(rows)


def test_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op13_prefix_trie"](spark, sf_small)) == wanted(rows)


def test_a_long_conversation_and_many_alike(spark):
    """One conversation has a third of all turns, and a third of all conversations are the same."""
    rows = [(0, t, "user", f"turn {t}") for t in range(700)]
    rows += [(20 * n, t, "user", f"turn {t}") for n in range(1, 120) for t in range(6)]
    rows += [(20 * n, 0, "user", f"own {n}") for n in range(200, 400)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert got(prefix_trie(table, block=64)) == wanted(rows)


def test_edges(spark):
    rows = [
        (None, 1, "user", "left out"), (5, None, None, None), (5, 1, "user", "x y"), (5, 0, "bot", None),
        (20, 0, "user", "long " * 30_000), (21, 0, "user", "short"), (7, 3, "r", "t"), (-3, 1, "r", "t"),
    ]
    extra = ", ".join(f"`{c}` string" for c in ("place", "p", "q", "number", "words", "_range", "element", "base"))
    table = spark.createDataFrame([(*r, *[None] * 8) for r in rows], f"{SCHEMA}, {extra}")
    assert got(prefix_trie(table)) == wanted(rows)
    assert got(prefix_trie(table.limit(0))) == []
    assert got(prefix_trie(table.where("text = 'left out'"))) == []


def test_repeated_and_tied_turns(spark):
    """Rows repeated are turns one after the other; ties have one order, whichever way they come."""
    rows = [(20, 0, "u", "a"), (20, 0, "u", "a"), (20, 0, "u", "b"), (40, 0, "u", "b"), (40, 0, "u", "a"), (40, 0, "u", "a")]
    found = got(prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert [(r[0], r[1], r[3]) for r in found] == [(20, 0, 2), (20, 1, 2), (20, 2, 2), (20, 3, 2)]
    assert found[-1][7] == hashlib.sha256(b"20,40").hexdigest()


def test_running_totals_across_ranges(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, rng.randrange(40)]), n, rng.randrange(1 << 40)) for n in range(3000)]
    df = spark.createDataFrame(rows, "g long, n long, v long").repartition(7)
    sums = running(df, "g", ["n"], {"v": "s"}, "test-running", xors={"v": "x"})
    totals = defaultdict(lambda: (0, 0))
    want = {}
    for g, n, v in rows:
        totals[g] = (totals[g][0] + v, totals[g][1] ^ v)
        want[n] = totals[g]
    assert {r.n: (r.s, r.x) for r in sums.collect()} == want
    assert running(df.limit(0), "g", ["n"], {"v": "s"}, "test-running").count() == 0


@pytest.mark.parametrize("block", [4, 50, 100_000])
def test_ranks_of_lists_in_any_order(spark, block):
    rng = random.Random(block)
    numbers = rng.sample(range(3000), 900)
    lists = [numbers[:600], numbers[600:899], numbers[899:]]
    rows, want = [], {}
    for one in lists:
        weights = [(rng.randrange(5), rng.randrange(1000)) for _ in one]
        for place, number in enumerate(one):
            following = one[place + 1] if place + 1 < len(one) else None
            rows.append((number, following, *weights[place]))
            want[number] = tuple(sum(w[k] for w in weights[place:]) for k in (0, 1))
    links = spark.createDataFrame(rows, "element long, following long, a long, b long")
    assert {r.element: (r.a, r.b) for r in rank_list(links, ["a", "b"], block).collect()} == want


def test_contract_one_block():
    elements, following = np.array([5, 2, 9, 7]), np.array([2, 9, 100, -1])
    head, offset, follows = contract(elements, following, np.array([[1], [10], [100], [3]]))
    assert elements[head].tolist() == [5, 5, 5, 7]
    assert offset[:, 0].tolist() == [0, 1, 11, 0]
    assert follows.tolist() == [1, 2, -1, -1]
