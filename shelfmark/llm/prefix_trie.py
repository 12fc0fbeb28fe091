"""A trie of conversations by shared first turns, with subtree sums by an Euler tour.

Every conversation is rebuilt first: its first turns, none to three by a checksum of its id,
are those of the conversation that its block of twenty ids begins with. A node is a distinct
sequence of first turns, known by the exclusive or of a 128-bit hash per place and turn, which
running totals give for conversations of any length. Nodes are numbered by their smallest
member and depth, so the nodes that only one conversation has follow one another.

Each node has an arc in and an arc out. An arc in leads to the first child's, or out again; an
arc out leads to the next sibling's arc in, or out of the parent. The list of arcs is ranked
across tasks (``scan.rank_list``), with the leaves and savings that stand on the arcs in; a
subtree's sum is what lies between a node's two arcs.

Defined results: null role or text is empty; turns go by number, null first, and turns of the
same number by a hash of role and text, so rows repeated are turns of their own, one after the
other. Rows without a conversation id are left out. A conversation without turns after
rebuilding is a member of the root. An empty table has no root and gives an empty result.
Texts of any length are hashed whole where they are read and never shuffled. Only the four
columns of the table are read, whatever others are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import staged, whole
from shelfmark.llm.scan import BLOCK, rank_list, running
from shelfmark.operators.joins import skew_join

#: Conversations that share a base, and the most turns taken from it.
FAMILY = 20
SHARED = 4
WORD = r"[^\x20\x09-\x0D]+"


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, a, b, words, one)``: two hashes of a turn's role and text, its words."""
    role, text = whole(F.col("role")), whole(F.col("text"))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("turn"), text, role).alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.lit(1).cast("long").alias("one"),
    )


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns ``(conv_id, place, a, b, words, last)`` of the rebuilt conversations, and one
    row ``(conv_id, length)`` per conversation."""
    ranked = running(turns, "conv_id", ["turn", "a", "b"], {"one": "place"}, "trie-turns")
    ranked = ranked.select("conv_id", "place", "a", "b", "words")
    sizes = staged(turns.groupBy("conv_id").agg(F.count("*").alias("own")), "trie-sizes")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    planned = sizes.select("conv_id", "own", shared.alias("shared"), base.alias("base")).join(
        sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("there")), "base", "left"
    )
    taken = F.least("shared", F.coalesce("there", F.lit(0)))
    convs = staged(
        planned.withColumn("taken", taken).withColumn(
            "length", F.col("taken") + F.greatest(F.col("own") - F.col("shared"), F.lit(0))
        ),
        "trie-conversations",
    )
    columns = ["conv_id", "place", "a", "b", "words", (F.col("place") == F.col("length")).alias("last")]
    own = (
        skew_join(ranked, convs.select("conv_id", "shared", "taken", "length"), ["conv_id"], "inner")
        .where(F.col("place") > F.col("shared"))
        .withColumn("place", F.col("place") - F.col("shared") + F.col("taken")).select(*columns)
    )
    # A base has at most FAMILY conversations, each with a few of its turns.
    lent = ranked.where((F.pmod("conv_id", F.lit(FAMILY)) == 0) & (F.col("place") < SHARED))
    borrowed = (
        lent.withColumnRenamed("conv_id", "base")
        .join(convs.select("conv_id", "base", "shared", "length"), "base")
        .where(F.col("place") <= F.col("shared")).select(*columns)
    )
    return own.unionAll(borrowed), convs.select("conv_id", "length")


def trie_nodes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The numbered nodes, and the nodes ``(p, q, conv_id)`` that conversations end at.

    A node is ``(p, q, depth, conv_id, n_convs, words, up_p, up_q, number)``: its hash, its
    parent's, and what the tour needs.
    """
    rebuilt, convs = rebuilt_turns(turns)
    placed = rebuilt.select(
        "*", F.xxhash64("place", "a", "b").alias("x"), F.xxhash64("b", "a", "place").alias("y")
    )
    steps = running(placed, "conv_id", ["place"], {}, "trie-steps", xors={"x": "p", "y": "q"})
    steps = steps.select(
        "conv_id", "place", "words", "last", "p", "q", F.col("p").bitwiseXOR(F.col("x")).alias("up_p"),
        F.col("q").bitwiseXOR(F.col("y")).alias("up_q"),
    )
    inner = steps.groupBy("p", "q").agg(
        F.first("place").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.first("words").alias("words"),
        F.first("up_p").alias("up_p"), F.first("up_q").alias("up_q"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where(
        "n_convs > 0"
    ).select(
        zero.alias("p"), zero.alias("q"), zero.alias("depth"), "conv_id", "n_convs",
        zero.alias("words"), F.lit(None).cast("long").alias("up_p"),
        F.lit(None).cast("long").alias("up_q"),
    )
    numbered = running(
        root.unionAll(inner).select("*", zero.alias("all"), F.lit(1).cast("long").alias("one")),
        "all", ["conv_id", "depth"], {"one": "number"}, "trie-numbers",
    ).drop("all", "one")
    ends = steps.where("last").select("p", "q", "conv_id").unionAll(
        convs.where("length = 0").select(zero.alias("p"), zero.alias("q"), "conv_id")
    )
    return staged(numbered, "trie-nodes"), ends


def end_digests(ends: DataFrame) -> DataFrame:
    """``(p, q, ends_sha256)``: SHA-256 of the ascending ids that end at a node, comma-joined.

    Ids are rendered where they lie, in ranges of node and id, so that a node where many end is
    cut over many tasks; the digest itself streams over these stretches in order.
    """
    name = ["p", "q", "conv_id", "ids"]

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = []
            for p, q, number in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if rows and rows[-1][:2] == [p, q]:
                    rows[-1][3].append(str(number))
                else:
                    rows.append([p, q, number, [str(number)]])
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns[:3]),
                     pa.array([",".join(ids) for ids in columns[3]], pa.string())], name,
                )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = running_hash = None
        done: list[tuple] = []
        for batch in batches:
            for p, q, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                if (p, q) == node:
                    running_hash.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, running_hash.hexdigest()))
                node, running_hash = (p, q), hashlib.sha256(ids.encode())
            if done:
                yield made(done)
                done = []
        if node is not None:
            yield made([(*node, running_hash.hexdigest())])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        p, q, text = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int64()), pa.array(q, pa.int64()), pa.array(text, pa.string())],
            ["p", "q", "ends_sha256"],
        )

    ranges = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["p", "q", "conv_id"]
    stretches = ends.select(*order).repartitionByRange(ranges, *order).sortWithinPartitions(
        *order
    ).mapInArrow(render, "p bigint, q bigint, conv_id bigint, ids string")
    return stretches.repartition("p", "q").sortWithinPartitions(*order).mapInArrow(
        digest, "p bigint, q bigint, ends_sha256 string"
    )


def euler_tour(children: DataFrame, numbers: DataFrame) -> DataFrame:
    """The arcs ``(element, following, leaf, saved)`` of all nodes.

    ``children`` has ``(number, parent, sibling, leaf, saved)`` of each node, the root's without
    a parent; ``numbers`` has ``(number, n_children)``. Node n's arc in is 2n, its arc out 2n + 1.
    """
    inward, outward = F.col("number") * 2, F.col("number") * 2 + 1
    first = children.where("sibling = 1").select(
        F.col("parent").alias("number"), F.col("number").alias("child")
    )
    into = numbers.join(first, "number", "left").select(
        inward.alias("element"), F.coalesce(F.col("child") * 2, outward).alias("following"),
        "leaf", "saved",
    )
    # The next sibling is the one a place further under the same parent: one row per key.
    later = children.where("parent is not null").select(
        "parent", (F.col("sibling") - 1).alias("sibling"), F.col("number").alias("next")
    )
    zero = F.lit(0).cast("long")
    out = children.join(later, ["parent", "sibling"], "left").select(
        outward.alias("element"),
        F.coalesce(F.col("next") * 2, F.col("parent") * 2 + 1).alias("following"),
        zero.alias("leaf"), zero.alias("saved"),
    )
    return into.unionAll(out)


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    turns = staged(hashed_turns(conversations), "trie-hashes")
    nodes, ends = trie_nodes(turns)
    parents = nodes.select(
        F.col("p").alias("up_p"), F.col("q").alias("up_q"), F.col("number").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    known = staged(skew_join(nodes, parents, ["up_p", "up_q"], "left"), "trie-parents")
    inner = known.where("parent is not null")
    counts = inner.groupBy(F.col("parent").alias("number")).agg(F.count("*").alias("n_children"))
    numbers = staged(
        known.select(
            "number", "p", "q", "conv_id", "depth", "parent_conv_id", "n_convs",
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        ).join(counts, "number", "left").withColumn(
            "n_children", F.coalesce("n_children", F.lit(0))
        ).withColumn("leaf", (F.col("n_children") == 0).cast("long")),
        "trie-numbers-counted",
    )
    siblings = running(
        inner.select("number", "parent", F.lit(1).cast("long").alias("one")),
        "parent", ["number"], {"one": "sibling"}, "trie-siblings",
    ).select("number", "parent", "sibling")
    missing = F.lit(None).cast("long")
    children = siblings.unionAll(
        known.where("parent is null").select("number", missing.alias("parent"), missing.alias("sibling"))
    )
    ranked = rank_list(euler_tour(children, numbers), ["leaf", "saved"], block)
    sign = F.when(F.col("element") % 2 == 0, 1).otherwise(-1)
    sums = ranked.groupBy(F.floor(F.col("element") / 2).cast("long").alias("number")).agg(
        F.sum(F.col("leaf") * sign).alias("n_leaves"), F.sum(F.col("saved") * sign).alias("saved_tokens")
    )
    none = F.sha2(F.lit(""), 256)
    return numbers.join(sums, "number").join(end_digests(ends), ["p", "q"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
