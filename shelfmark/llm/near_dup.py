"""Near duplicates by a chosen-path similarity join over minwise tokens.

Documents with the same shingle set form a class with one representative. Each of several
independent trees starts with all representatives; a node chooses, by its own hash, a
position of the minhash signature, and branches by the tokens its documents have there.
Small nodes are compared exhaustively by signature, larger ones branch on, by one or two
positions, so that documents of the wanted similarity keep meeting. A document of a crowded
node carries its signature and the list of its open nodes in one row, and branches in its task.
Crowded nodes that are one family but for a few documents don't branch. They and nodes that
don't part are compared block against block, each document with all those that it
is not yet connected to. What is similar by signature forms clusters, within which links are
confirmed on the full sets: all pairs of a cluster of bounded size; of a larger one the pairs
that met in small nodes or blocks, as long as their documents are not linked already by way
of others.

Defined results: a null text is empty; a text without words has no set and no links; equal
sets are linked, so rows repeated or with the same words share a component. A null id is
never a component's id while another is there. An empty table gives an empty result. A text of
any length is shingled whole; a task holds one text or a slice of a few megabytes. Only the id
and the text are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.operators.joins import skew_join
from shelfmark.llm.common import components, sized_join, staged, whole
from shelfmark.llm.shingles import byte_slices, mix, shingle_sets


@dataclass(frozen=True)
class Settings:
    """What the join is built with; none of these limits what can be found but ``trees``."""

    words: int = 5
    percent: int = 80
    tokens: int = 128
    trees: int = 16
    #: Trees more for documents that the first ones leave in a node too large to compare.
    more_trees: int = 32
    #: Trees whose nodes link large clusters before what is left apart is looked at.
    first_trees: int = 2
    first_depth: int = 3
    #: Levels that a node too large to compare goes down at a time.
    step: int = 2
    max_depth: int = 19
    small_node: int = 1024
    small_cluster: int = 256
    #: Shingles compared in one group, and gathered in one task at a time.
    group_shingles: int = 2_000_000
    #: Rows of a counted table that a join may broadcast, some 50 bytes each.
    broadcast_rows: int = 500_000

    @property
    def threshold(self) -> float:
        return self.percent / 100

    @property
    def least_matches(self) -> int:
        """Equal tokens that a pair of the wanted similarity falls short of once in 30,000."""
        return int(self.threshold * self.tokens - 4 * self.spread)

    @property
    def sure_matches(self) -> int:
        """Equal tokens that a pair of the wanted similarity exceeds once in 40."""
        return int(self.threshold * self.tokens + 2 * self.spread)

    @property
    def spread(self) -> float:
        """The standard deviation of a pair's equal tokens."""
        return (self.threshold * (1 - self.threshold) * self.tokens) ** 0.5


def multipliers(count: int) -> np.ndarray:
    """One odd factor per minwise token."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(shingles: np.ndarray, starts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minwise tokens, 16 bits each, of sets that follow one another; none may be empty."""
    tokens = np.empty((len(starts), len(factors)), np.uint16)
    for place, factor in enumerate(factors):
        least = np.minimum.reduceat(shingles * factor, starts)
        tokens[:, place] = (mix(least) >> np.uint64(48)).astype(np.uint16)
    return tokens


SKETCH = "doc_id bigint, n_shingles bigint, set_key binary, tokens binary"


def sketch(docs: DataFrame, id_col: str, text_col: str, settings: Settings) -> DataFrame:
    """Set size, a 128-bit key of the set and the minhash signature of each document."""
    words, factors = settings.words, multipliers(settings.tokens)

    def rows(numbers: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(sizes)
        keys: list[bytes | None] = [None] * len(sets)
        tokens: list[bytes | None] = [None] * len(sets)
        if len(full):
            joined = np.concatenate(sets)
            starts = (np.cumsum(sizes) - sizes)[full]
            halves = np.stack([
                np.add.reduceat(mix(joined ^ np.uint64(salt)), starts) for salt in (1, 2)
            ], axis=1)
            signed = signature(joined, starts, factors)
            for place, half, row in zip(full.tolist(), halves, signed, strict=True):
                keys[place], tokens[place] = half.tobytes(), row.tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(sizes), pa.array(keys, pa.binary()),
             pa.array(tokens, pa.binary())],
            ["doc_id", "n_shingles", "set_key", "tokens"],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in byte_slices(batch, 1)):
            numbers = part.column(0).to_pylist()
            done, sets, held = 0, [], 0
            for found in shingle_sets(part.column(1), words):
                sets.append(found)
                held += len(found)
                if held > 100_000:
                    yield rows(numbers[done : done + len(sets)], sets)
                    done, sets, held = done + len(sets), [], 0
            if sets:
                yield rows(numbers[done:], sets)

    text = whole(F.col(text_col))
    return docs.select(F.col(id_col).cast("long"), text.alias("text")).mapInArrow(task, SKETCH)


def token_matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, width)


def branch(
    nodes: np.ndarray, owners: np.ndarray, tokens: np.ndarray, steps: int, threshold: float = 1.0
) -> tuple[np.ndarray, np.ndarray]:
    """Go ``steps`` levels down from each node with its document, ``tokens[owner]``.

    A node chooses 1 / threshold positions on average, so that two documents of that
    similarity meet in one child of each node on average; with a threshold of 1 it chooses
    one, and two documents of similarity J meet again at each level with probability J.
    """
    count = np.uint64(tokens.shape[-1])
    second = np.uint64(int((1 / threshold - 1) * 2**32))
    for _ in range(steps):
        twice = (mix(nodes ^ np.uint64(0xA5A5A5A5)) >> np.uint64(32)) < second
        nodes = np.concatenate([nodes, nodes[twice] ^ np.uint64(0x5DEECE66D)])
        owners = np.concatenate([owners, owners[twice]])
        place = mix(nodes ^ np.uint64(0xC3C3C3C3)) % count
        token = tokens[owners, place.astype(np.int64)].astype(np.uint64)
        nodes = mix(nodes + (token << np.uint64(8)) + place + np.uint64(1))
    return nodes, owners


FRONTIER = "node bigint, tree int, rep bigint, n bigint, origin bigint"
FRONTIER_NAMES = ["node", "tree", "rep", "n", "origin"]


def frontier_rows(nodes: np.ndarray, trees: np.ndarray, reps, n, origins: np.ndarray | None) -> pa.RecordBatch:
    origin = pa.nulls(len(nodes), pa.int64()) if origins is None else pa.array(origins)
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes.view(np.int64)), pa.array(trees.astype(np.int32)), reps, n, origin],
        FRONTIER_NAMES,
    )


def descend(crowded: DataFrame, steps: int, settings: Settings) -> DataFrame:
    """Children ``steps`` levels below the open nodes of ``(rep, n, tokens, open)``.

    A document's open nodes are an array beside its one signature, and only pairs of child and
    document leave the task.
    """
    width, threshold = settings.tokens, settings.threshold

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.slice(start, 1024)
                tokens = token_matrix(part.column(2), width)
                lists = part.column(3)
                owners = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
                node, tree, origin = (x.to_numpy() for x in lists.flatten().flatten())
                at = np.arange(len(node))
                nodes, at = branch(node.view(np.uint64), at, tokens[owners], steps, threshold)
                take = pa.array(owners[at])
                yield frontier_rows(
                    nodes, tree[at], part.column(0).take(take), part.column(1).take(take), origin[at]
                )

    return crowded.select("rep", "n", "tokens", "open").mapInArrow(task, FRONTIER)


def plant(reps: DataFrame, first: int, count: int, steps: int, settings: Settings) -> DataFrame:
    """The nodes of ``count`` trees, from number ``first`` on, ``steps`` levels below the root."""
    width = settings.tokens

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = mix(np.arange(first + 1, first + count + 1, dtype=np.uint64))
        numbers = np.arange(first, first + count, dtype=np.int32)
        for batch in batches:
            if len(batch):
                at = np.repeat(np.arange(len(batch)), count)
                tokens = token_matrix(batch.column(2), width)
                nodes, _ = branch(np.tile(roots, len(batch)), at, tokens, steps)
                take = pa.array(at)
                yield frontier_rows(
                    nodes, np.tile(numbers, len(batch)), batch.column(0).take(take),
                    batch.column(1).take(take), None,
                )

    return reps.select("rep", "n", "tokens").mapInArrow(task, FRONTIER)


def settle(frontier: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame | None]:
    """The rows ``(node, tree, rep)`` of small nodes, and the rows of larger ones.

    ``origin`` is the size that a large row's node had when its tree was planted.
    """
    frontier = staged(frontier, "near-frontier")
    small = (F.count("*") <= settings.small_node) & (
        (F.sum("n") <= settings.group_shingles) | (F.count("*") == 2)
    )
    sizes = staged(
        frontier.groupBy("node").agg(F.count("*").alias("size"), small.alias("small"))
        .where("size > 1"),
        "near-sizes",
    )
    counts = sizes.groupBy().agg(
        F.count_if("small").alias("small"), F.count_if(~F.col("small")).alias("large")
    ).first()
    members = sized_join(
        frontier, sizes.where("small").select("node"), ["node"], counts.small, settings.broadcast_rows
    ).select("node", "tree", "rep")
    if not counts.large:
        return members, None
    large = sizes.where("not small").select("node", "size")
    rest = sized_join(frontier, large, ["node"], counts.large, settings.broadcast_rows)
    return members, staged(
        rest.withColumn("origin", F.coalesce("origin", "size")).select(*FRONTIER_NAMES, "size"),
        "near-large",
    )


def small_nodes(reps: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame | None]:
    """The distinct small nodes of all trees, ``(gid, tree, members)``, and the rows
    ``(node, tree, rep, n)`` of nodes to compare in blocks.

    Nodes of one are done with. A crowded node that is one family but for a few documents is
    compared in blocks at once, whole, so its documents need no more trees. Other nodes too large to compare branch on, two levels at a time,
    and their documents get more trees; only these documents' signatures are read again. As
    a node chooses 1 / threshold positions on average, a similar pair that meets at
    ``first_depth`` still meets d levels below in about one tree of 1 + d / 7. Where a node
    keeps more of its documents than the root of the threshold a level, two of them are as
    alike as the wanted pairs (``dense``): it gains nothing from branching, and its rows would
    only multiply. Like those left at ``max_depth`` it is compared in blocks.
    """
    depth = settings.first_depth
    members, rest = settle(plant(reps, 0, settings.trees, depth, settings), settings)
    kept = [members]
    stuck: list[DataFrame] = []
    if rest is not None:
        family, rest = families(rest, reps, settings)
        stuck.append(family)
        rest = None if rest.isEmpty() else rest
    if rest is not None:
        wanted = staged(rest.select("rep").distinct(), "near-wanted")
        crowded = staged(
            sized_join(
                reps.select("rep", "n", "tokens"), wanted, ["rep"], wanted.count(),
                settings.broadcast_rows,
            ),
            "near-crowded",
        )
        more, larger = settle(
            plant(crowded, settings.trees, settings.more_trees, depth, settings), settings
        )
        kept.append(more)
        rest = rest if larger is None else rest.unionAll(larger.select(*rest.columns))
        while rest is not None and depth < settings.max_depth:
            steps = min(settings.step, settings.max_depth - depth)
            depth += steps
            open_nodes = staged(
                rest.groupBy("rep").agg(F.collect_list(F.struct("node", "tree", "origin")).alias("open")), "near-open"
            )
            more, rest = settle(descend(
                sized_join(crowded, open_nodes, ["rep"], open_nodes.count(), settings.broadcast_rows // 10),
                steps, settings,
            ), settings)
            kept.append(more)
            levels = depth - settings.first_depth
            if rest is not None and levels >= 4:
                dense = F.col("size") > settings.threshold ** (levels / 2) * F.col("origin")
                stuck.append(rest.where(dense).withColumn("tree", F.lit(0)))
                rest = rest.where(~dense)
                rest = None if rest.isEmpty() else rest
        if rest is not None:
            stuck.append(rest.withColumn("tree", F.lit(0)))
    nodes = reduce(DataFrame.unionAll, kept).groupBy("node").agg(
        F.sort_array(F.collect_set("rep")).alias("members"), F.min("tree").alias("tree")
    ).where(F.size("members") > 1)
    groups = staged(
        nodes.groupBy("members").agg(F.min("tree").alias("tree"))
        .select(F.xxhash64("members").alias("gid"), "tree", "members"),
        "near-groups",
    )
    if not stuck:
        return groups, None
    left = staged(reduce(DataFrame.unionAll, (
        rows.select("node", "tree", "rep", "n") for rows in stuck
    )), "near-stuck")
    return groups, None if left.isEmpty() else left


def families(rows: DataFrame, reps: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The rows of crowded nodes that are one family but for a few documents, and the rows of
    the others.

    A family is what documents surely alike by signature connect, looked for within blocks of
    each node. To compare the few, at most a small node's worth, with the whole node in blocks
    takes some rows per document, where branching takes rows in each tree and level. This only
    decides how a node is compared, not what is found in it.
    """
    signed, count = with_signatures(within_blocks(rows.select("node", "tree", "rep"), settings), reps, settings)
    labels = components(
        likely_links(signed, count, settings, settings.sure_matches), "near-family", settings.broadcast_rows
    ).select(F.col("id").alias("rep"), F.col("component").alias("label"))
    of_label = rows.select("node", "rep", "n").join(labels, "rep", "left").groupBy(
        "node", F.coalesce("label", "rep").alias("label")
    ).agg(F.count("*").alias("count"), F.sum("n").alias("n"))
    few = F.sum("count") - F.max("count") <= settings.small_node
    fits = F.sum("n") * settings.small_node <= F.sum("count") * settings.group_shingles
    nodes = staged(of_label.groupBy("node").agg((few & fits).alias("whole")).where("whole").select("node"), "near-whole")
    count = nodes.count()
    return tuple(
        sized_join(rows, nodes, ["node"], count, settings.broadcast_rows, how)
        for how in ("left_semi", "left_anti")
    )


def block_of(salt: int | Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64("rep", F.lit(salt)), blocks)


def within_blocks(stuck: DataFrame, settings: Settings) -> DataFrame:
    """``(gid, tree, rep)``: the rows ``(node, tree, rep)`` of each node, dealt to blocks by hash,
    in each node another way."""
    sizes = stuck.groupBy("node").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / (settings.small_node // 2)).cast("long")
    return skew_join(stuck, sizes, ["node"], "inner").select(
        F.xxhash64(F.lit("block"), "node", block_of(F.col("node"), blocks)).alias("gid"),
        "tree", "rep",
    )


def across_blocks(stuck: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """``(gid, tree, rep)``: groups in which all rows of a node meet that have different labels.

    Of two such rows one at least has not the node's most frequent label. Those rows, in
    slices, are compared with each block of all rows; a node of one label is done with.
    """
    rows = staged(
        stuck.select("node", "rep").join(labels, "rep", "left").withColumn(
            "label", F.coalesce("label", "rep")
        ),
        "near-stuck-labels",
    )
    of_label = rows.groupBy("node", "label").agg(F.count("*").alias("count"))
    nodes = of_label.groupBy("node").agg(
        F.max_by("label", F.struct("count", "label")).alias("most"), F.sum("count").alias("size"),
        (F.sum("count") - F.max("count")).alias("others"),
    ).where("others > 0")
    half = settings.small_node // 2
    blocks, slices = (F.ceil(F.col(c) / half).cast("long") for c in ("size", "others"))
    dealt = staged(
        skew_join(rows, nodes, ["node"], "inner").select(
            "node", "rep", (F.col("label") != F.col("most")).alias("other"),
            blocks.alias("blocks"), slices.alias("slices"),
        ),
        "near-dealt",
    )
    last = {c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1) for c in ("blocks", "slices")}
    every = dealt.select(
        "node", "rep", block_of(0, F.col("blocks")).alias("block"), F.explode(last["slices"]).alias("slice")
    )
    others = dealt.where("other").select(
        "node", "rep", F.explode(last["blocks"]).alias("block"), block_of(1, F.col("slices")).alias("slice")
    )
    return every.unionAll(others).select(
        F.xxhash64(F.lit("blocks"), "node", "block", "slice").alias("gid"),
        F.lit(0).alias("tree"), "rep",
    )


def spanning(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that join what the symmetric matrix connects: each component's first with the rest."""
    left = np.ones(len(adjacent), bool)
    pairs = []
    for first in range(len(adjacent)):
        if left[first]:
            reached = np.array([first])
            left[first] = False
            while len(reached):
                reached = np.flatnonzero(adjacent[reached].any(0) & left)
                left[reached] = False
                pairs += [(first, other) for other in reached.tolist()]
    return pairs


def matches(tokens: np.ndarray) -> np.ndarray:
    """The number of equal tokens of each two rows."""
    return np.stack([(tokens == row).sum(1) for row in tokens])


def linked_sets(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which two sets have Jaccard similarity of so many percent or more."""
    sizes = np.array([len(s) for s in sets], np.int64)
    count = len(sets)
    if count == 2:
        small, large = sorted(sets, key=len)
        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
        common = np.full((2, 2), int((large[at] == small).sum()))
    else:
        owners = np.repeat(np.arange(count), sizes)
        _, kinds, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[kinds] > 1
        columns = np.cumsum(times > 1) - 1
        owners, columns = owners[shared], columns[kinds[shared]]
        order = np.argsort(columns, kind="stable")
        owners, columns = owners[order], columns[order]
        total = int((times > 1).sum())
        width = 1 << 12
        common = np.zeros((count, count), np.int64)
        for start in range(0, total, width):
            a, b = np.searchsorted(columns, [start, start + width])
            block = np.zeros((count, min(width, total - start)), np.float32)
            block[owners[a:b], columns[a:b] - start] = 1
            common += (block @ block.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    return 100 * common >= percent * union


def crossing(tokens: np.ndarray, labels: np.ndarray, least: int) -> list[int]:
    """The rows that have so many tokens equal to those of a row of another label."""
    if (labels == labels[0]).all():
        return []
    return np.flatnonzero(((matches(tokens) >= least) & (labels[:, None] != labels[None, :])).any(1)).tolist()


def by_group(rows: DataFrame, buckets: int, schema: str, found_in) -> DataFrame:
    """Run ``found_in`` on each group of rows with the same ``gid``, many groups to a task.

    It gets the sorted representatives, each once, and the other columns, and gives rows of
    numbers.
    """
    others = [name for name in rows.columns if name not in ("gid", "rep")]
    names = [field.split()[0] for field in schema.split(", ")]

    def task(table: pa.Table) -> pa.Table:
        table = table.sort_by([("gid", "ascending"), ("rep", "ascending")]).combine_chunks()
        gids, reps = table.column("gid").to_numpy(), table.column("rep").to_numpy()
        again = np.append(False, (gids[1:] == gids[:-1]) & (reps[1:] == reps[:-1]))
        if again.any():
            table = table.filter(pa.array(~again)).combine_chunks()
            gids, reps = gids[~again], reps[~again]
        columns = [table.column(name) for name in others]
        bounds = np.flatnonzero(np.append(True, gids[1:] != gids[:-1])).tolist() + [len(gids)]
        found = [
            row for start, stop in zip(bounds, bounds[1:], strict=False) if stop - start > 1
            for row in found_in(
                gids[start], reps[start:stop], *(c.slice(start, stop - start) for c in columns)
            )
        ]
        numbers = np.array(found, np.int64).reshape(-1, len(names))
        return pa.table({name: numbers[:, place] for place, name in enumerate(names)})

    bucket = F.pmod(F.xxhash64("gid"), F.lit(buckets))
    return rows.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(
        lambda table: task(table.drop_columns(["bucket"])), schema
    )


GROUP_ROWS = 20_000


def likely_links(signed: DataFrame, rows: int, settings: Settings, least: int) -> DataFrame:
    """Pairs ``(a, b)`` that connect what has ``least`` equal tokens or more in each group."""
    width = settings.tokens

    def found_in(_, reps, tokens):
        alike = matches(token_matrix(tokens, width)) >= least
        return [(reps[a], reps[b]) for a, b in spanning(alike)]

    exploded = signed.select(F.explode("met.gid").alias("gid"), "rep", "tokens")
    return by_group(exploded, max(1, rows // GROUP_ROWS), "a bigint, b bigint", found_in)


def left_apart(signed: DataFrame, rows: int, settings: Settings) -> DataFrame:
    """The rows ``(gid, rep, n)`` similar by signature to one of another ``label`` in their group."""
    width, least = settings.tokens, settings.least_matches

    def found_in(gid, reps, tokens, labels, sizes):
        apart = crossing(token_matrix(tokens, width), labels.to_numpy(), least)
        return [(gid, reps[at], sizes[at].as_py()) for at in apart]

    return by_group(
        signed.select(F.explode("met.gid").alias("gid"), "rep", "tokens", "label", "n"),
        max(1, rows // GROUP_ROWS), "gid bigint, rep bigint, n bigint", found_in,
    )


def confirmed_links(shingled: DataFrame, volume: int, settings: Settings) -> DataFrame:
    """Pairs ``(a, b)`` that connect what is linked on full sets in each group of
    ``(gid, rep, shingles)``, of so many shingles in all."""
    percent = settings.percent

    def found_in(_, reps, shingles):
        values = [np.frombuffer(value.as_buffer(), np.uint64) for value in shingles]
        return [(reps[a], reps[b]) for a, b in spanning(linked_sets(values, percent))]

    return by_group(
        shingled.select("gid", "rep", "shingles"), max(1, volume // settings.group_shingles),
        "a bigint, b bigint", found_in,
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per document: the id, ``n_shingles``, ``component_id`` and ``kept``."""
    sketched = staged(sketch(docs, id_col, text_col, settings), "near-sketch")
    classes = staged(
        sketched.where("n_shingles > 0").groupBy("set_key").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
            F.first("tokens").alias("tokens"),
        ),
        "near-classes",
    )
    reps = classes.where("rep is not null")
    groups, stuck = small_nodes(reps, settings)
    met = groups.select("gid", "tree", F.explode("members").alias("rep"))
    if stuck is not None:
        met = met.unionAll(within_blocks(stuck, settings))
    signed, rows = with_signatures(met, reps, settings)
    clusters = components(
        likely_links(signed, rows, settings, settings.least_matches), "near-alike", settings.broadcast_rows
    )
    if stuck is not None:
        labels = clusters.select(F.col("id").alias("rep"), F.col("component").alias("label"))
        further, many = with_signatures(across_blocks(stuck, labels, settings), reps, settings)
        hung = clusters.where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
        clusters = components(
            hung.unionAll(likely_links(further, many, settings, settings.least_matches)),
            "near-alike", settings.broadcast_rows,
        )
    known, large = sized_clusters(clusters, reps, settings)
    links = links_of_clusters(known, docs, id_col, text_col, settings)
    if large:
        links = links.unionAll(links_of_crowds(
            known, signed, rows, stuck, reps, (docs, id_col, text_col), settings
        ))
    linked = components(links, "near-links", settings.broadcast_rows)
    named = staged(
        linked.select(F.col("id").alias("rep"), "component").join(
            classes.select("set_key", "rep"), "rep"
        ).select("set_key", "component"),
        "near-named",
    )
    # Of a class without links the component is its own least id.
    named = classes.select("set_key", "rep").join(named, "set_key", "left").select(
        "set_key", F.coalesce("component", "rep").alias("component")
    )
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return skew_join(
        sketched.select("doc_id", "n_shingles", "set_key"), named, ["set_key"], "left"
    ).select(
        F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def with_signatures(met: DataFrame, reps: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    """One row ``(rep, tokens, met)`` per representative of the groups ``(gid, tree, rep)``: its
    signature and the groups it is in; and how many rows the groups have."""
    met = staged(
        met.groupBy("rep").agg(F.collect_list(F.struct("gid", "tree")).alias("met")), "near-met"
    )
    sums = met.agg(F.count("*").alias("reps"), F.coalesce(F.sum(F.size("met")), F.lit(0)).alias("rows")).first()
    tokens = reps.select("rep", "tokens")
    signed = sized_join(tokens, met, ["rep"], sums.rows, settings.broadcast_rows)
    return staged(signed, "near-signed"), sums.rows


def sized_clusters(
    clusters: DataFrame, reps: DataFrame, settings: Settings
) -> tuple[DataFrame, bool]:
    """``(rep, component, set_key, n, fits)`` of the clusters, and whether any is too large
    to compare as one group."""
    named = staged(clusters.select(F.col("id").alias("rep"), "component"), "near-clustered")
    known = staged(
        sized_join(
            reps.select("rep", "set_key", "n"), named, ["rep"], named.count(), settings.broadcast_rows
        ),
        "near-known",
    )
    fits = (F.count("*") <= settings.small_cluster) & (
        (F.sum("n") <= settings.group_shingles) | (F.count("*") == 2)
    )
    sizes = known.groupBy("component").agg(fits.alias("fits"))
    known = staged(skew_join(known, sizes, ["component"], "inner"), "near-sized")
    return known, not known.where("not fits").isEmpty()


def links_of_clusters(
    known: DataFrame, docs: DataFrame, id_col: str, text_col: str, settings: Settings
) -> DataFrame:
    """Pairs that connect what is linked in clusters of bounded size, each compared as one
    group: the sets go straight from their texts to the one group they are in."""
    fitting = known.where("fits").select(
        F.xxhash64(F.lit("cluster"), "component").alias("gid"), "rep", "set_key", "n"
    )
    volume = fitting.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sets = full_sets(docs, id_col, text_col, fitting, settings)
    return staged(confirmed_links(sets, volume, settings), "near-cluster-links")


def links_of_crowds(
    known: DataFrame, signed: DataFrame, rows: int, stuck: DataFrame | None, reps: DataFrame,
    texts: tuple[DataFrame, str, str], settings: Settings,
) -> DataFrame:
    """Pairs that connect what is linked in clusters too large for one group.

    A cluster is compared in the nodes of the first trees; then, in all nodes and between the
    blocks of nodes that did not part, what is similar by signature but not yet connected.
    """
    crowds = staged(known.where("not fits").select("rep", "component", "set_key", "n"), "near-crowds")
    count = crowds.count()
    sets = staged(full_sets(
        *texts, crowds.select(F.lit(0).cast("long").alias("gid"), "rep", "set_key"), settings
    ).drop("gid"), "near-sets")

    def confirmed(members: DataFrame, name: str) -> DataFrame:
        """Links in the groups ``(gid, rep, n)``; a set is joined once with all its groups."""
        of_rep = staged(
            members.groupBy("rep").agg(F.collect_set("gid").alias("gids"), F.first("n").alias("n")), name
        )
        sums = of_rep.agg(
            F.coalesce(F.sum(F.size("gids")), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.size("gids") * F.col("n")), F.lit(0)).alias("volume"),
        ).first()
        shingled = sized_join(
            sets, of_rep.select("rep", "gids"), ["rep"], sums.rows, settings.broadcast_rows
        ).select(F.explode("gids").alias("gid"), "rep", "shingles")
        return staged(confirmed_links(shingled, sums.volume, settings), f"{name}-links")

    first_gids = F.filter("met", lambda one: one["tree"] < settings.first_trees)["gid"]
    by_node = sized_join(
        signed.select("rep", first_gids.alias("gids")), crowds.select("rep", "component", "n"),
        ["rep"], count, settings.broadcast_rows,
    ).select(F.explode("gids").alias("gid"), "rep", "component", "n")
    links = confirmed(by_node.select(F.xxhash64("gid", "component").alias("gid"), "rep", "n"), "near-first")

    def labelled(links: DataFrame) -> DataFrame:
        labels = components(links, "near-labels", settings.broadcast_rows).select(
            F.col("id").alias("rep"), F.col("component").alias("label")
        )
        return staged(crowds.select("rep", "n").join(labels, "rep", "left").select(
            "rep", "n", F.coalesce("label", "rep").alias("label")
        ), "near-labelled")

    labels = labelled(links)
    apart = left_apart(
        sized_join(signed, labels, ["rep"], count, settings.broadcast_rows), rows, settings,
    )
    links = links.unionAll(confirmed(apart, "near-apart"))
    if stuck is not None:
        labels = labelled(links)
        known_stuck = sized_join(stuck.select("node", "rep"), labels.select("rep"), ["rep"], count, settings.broadcast_rows)
        met = across_blocks(known_stuck, labels.select("rep", "label"), settings)
        further, many = with_signatures(met, reps, settings)
        apart = left_apart(sized_join(further, labels, ["rep"], count, settings.broadcast_rows), many, settings)
        links = links.unionAll(confirmed(apart, "near-blocks"))
    return links


def full_sets(
    docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, settings: Settings
) -> DataFrame:
    """``(gid, rep, shingles)`` of the wanted ``(gid, rep, set_key)``, read again from the texts.

    Where the representatives are few enough they are broadcast, and only their texts
    leave the scan. A row that shares a representative's id but not its set is left out; where
    ids are repeated with their sets, one row of them is kept.
    """
    words = settings.words
    wanted = staged(wanted.select("gid", "rep", "set_key"), "near-texts")
    count = wanted.count()
    ids = docs.select(F.col(id_col).cast("long").alias("rep"))
    found_rows = sized_join(ids, wanted.select("rep"), ["rep"], count, settings.broadcast_rows).count()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in byte_slices(batch, 1)):
            gids, reps, keys = (part.column(place).to_pylist() for place in (3, 0, 2))
            rows, held = [], 0
            for gid, rep, key, found in zip(gids, reps, keys, shingle_sets(part.column(1), words), strict=True):
                halves = [int(mix(found ^ np.uint64(salt)).sum(dtype=np.uint64)) for salt in (1, 2)]
                if np.array(halves, np.uint64).tobytes() == key:
                    rows.append((gid, rep, found.tobytes()))
                    held += len(found)
                if held > 250_000:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    def made(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        gids, reps, sets = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(gids, pa.int64()), pa.array(reps, pa.int64()), pa.array(sets, pa.binary())],
            ["gid", "rep", "shingles"],
        )

    text: Column = whole(F.col(text_col))
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), text.alias("text"))
    found = (
        sized_join(texts, wanted, ["rep"], count, settings.broadcast_rows)
        .select("rep", "text", "set_key", "gid")
        .mapInArrow(task, "gid bigint, rep bigint, shingles binary")
    )
    return found if found_rows <= count else found.dropDuplicates(["gid", "rep"])


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """The documents without all but one of each component, columns unchanged.

    The one with the component's id stays, so ids are taken to name one document each; all
    rows without an id stay. Rows to drop are few beside the documents, and are broadcast up
    to a counted ``broadcast_rows``.
    """
    judged = near_duplicates(docs, id_col, text_col, settings)
    losers = staged(
        judged.where(~F.col("kept")).select(F.col(id_col).alias("_losing_id")).distinct(), "near-losers"
    )
    if losers.count() <= settings.broadcast_rows:
        losers = F.broadcast(losers)
    return docs.join(losers, docs[id_col] == losers["_losing_id"], "left_anti")
