"""Lines that many documents share, dropped by way of a sharded minimal perfect hash.

A line's key is the line without white space at both ends, A-Z in lower case; it is known by
128 bits of hash. Documents are counted per key, combined in the scan's own tasks before the
one shuffle of hashes. The distinct hashes that reach the threshold are dealt to shards by
their first half; each shard becomes a minimal perfect hash with an array of fingerprints (the
second half) and one of counts. Documents probe these arrays and are never joined with lines:
a line whose fingerprint is not at its place is in too few documents.

The arrays go to the tasks in rounds of at most ``round_bytes``, a bound that the shards'
counted sizes are checked against before any is sent; documents are read once per round, and
whatever the earlier rounds found is carried as a bit per line.

Defined results: a null or empty text is one empty line, which has no key and stays; so do all
lines shorter than ``min_chars`` code points. A document counts once per key however often it
holds it; repeated rows count as documents each, null ids too. Lines that stay keep their
bytes, ``\\r`` and outer white space included. An empty table gives an empty result. A text of
any length is worked on whole; a task holds one text or a slice of a few megabytes. Only the
id and the text are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import staged, whole
from shelfmark.llm.shingles import byte_slices, mix

MIN_DOCS = 10
MIN_CHARS = 1
#: Keys of a shard, on average.
SHARD_KEYS = 1 << 16
#: Bytes of index sent to the tasks at a time.
ROUND_BYTES = 32 << 20
#: Bytes that a key takes in a shard: fingerprint, count, and some five bits of hash.
KEY_BYTES = 13
WHITE = b" \t\n\v\f\r"
#: Slots per key on each level of the hash.
SPREAD = 2


def line_hashes(lines: Sequence[bytes], min_chars: int = MIN_CHARS) -> np.ndarray:
    """The 128-bit key hash of each line, as two columns; both zero for a line without a key."""
    digest = xxhash.xxh3_128_digest
    none = bytes(16)
    keys = (line.strip(WHITE) for line in lines)
    if min_chars > 1:
        keys = (key if len(key.decode()) >= min_chars else b"" for key in keys)
    joined = b"".join(digest(key.lower()) if key else none for key in keys)
    return np.frombuffer(joined, np.uint64).reshape(-1, 2)


def distinct_rows(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of two columns, and how often each occurs."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    ordered = values[np.lexsort((values[:, 1], values[:, 0]))]
    first = np.flatnonzero(np.append(True, (ordered[1:] != ordered[:-1]).any(1)))
    return ordered[first], np.diff(np.append(first, len(ordered)))


@dataclass
class PerfectHash:
    """A minimal perfect hash of 128-bit keys: each key has a place of its own, below the number
    of keys. A key that was not there when it was built gets some place, or -1.

    On each level a key has one slot; keys alone in theirs stay there, the others go on to the
    next. A key's place is the number of taken slots before its own.
    """

    level_sizes: np.ndarray
    words: np.ndarray

    def __post_init__(self):
        taken = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(taken) - taken

    @staticmethod
    def slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        return (mix(mix(keys[:, 0] ^ seed) + keys[:, 1]) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, parts = [], []
        left = keys
        while len(left):
            size = -(-SPREAD * len(left) // 64) * 64
            slots = cls.slots(left, len(sizes), size)
            alone = np.bincount(slots, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~alone[slots]]
        words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return cls(np.array(sizes, np.int64), words)

    def find(self, keys: np.ndarray) -> np.ndarray:
        places = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        start = 0
        for level, size in enumerate(self.level_sizes.tolist()):
            if not len(open_):
                break
            slots = start + self.slots(keys[open_], level, size)
            word, bit = slots >> 6, (slots & 63).astype(np.uint64)
            content = self.words[word]
            hit = (content >> bit) & np.uint64(1) == 1
            below = content & ((np.uint64(1) << bit) - np.uint64(1))
            places[open_[hit]] = (self.before[word] + np.bitwise_count(below))[hit]
            open_ = open_[~hit]
            start += size
        return places


@dataclass
class Shard:
    """The keys of a shard: their perfect hash, and fingerprints and counts by place."""

    hash: PerfectHash
    prints: np.ndarray
    counts: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray) -> Shard:
        made = PerfectHash.build(keys)
        places = made.find(keys)
        prints, by_place = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint32)
        prints[places] = keys[:, 1]
        by_place[places] = np.minimum(counts, 0xFFFFFFFF)
        return cls(made, prints, by_place)

    def count(self, keys: np.ndarray) -> np.ndarray:
        """The number of documents of each key, 0 for keys that are not in the shard."""
        places = self.hash.find(keys)
        known = places >= 0
        known[known] = self.prints[places[known]] == keys[known, 1]
        found = np.zeros(len(keys), np.int64)
        found[known] = self.counts[places[known]]
        return found


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys[:, 0] >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def count_lines(docs: DataFrame, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(first, second, docs)``: the hash of each key and the number of documents with it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 0):
                kinds = [
                    distinct_rows(line_hashes(text.encode().split(b"\n"), min_chars))[0]
                    for text in part.column(0).to_pylist()
                ]
                keys, counts = distinct_rows(np.concatenate(kinds))
                keyed = keys.any(1)
                keys, counts = keys[keyed].view(np.int64), counts[keyed]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(counts)],
                    ["first", "second", "docs"],
                )

    found = docs.select(whole(F.col(text_col)).alias("text")).mapInArrow(
        task, "first bigint, second bigint, docs bigint"
    )
    return found.groupBy("first", "second").agg(F.sum("docs").alias("docs"))


SHARDS = "shard bigint, keys bigint, levels binary, words binary, prints binary, counts binary"


def build_index(frequent: DataFrame, shards: int) -> DataFrame:
    """One row per shard of the keys ``(first, second, docs)``, its arrays as bytes."""

    def build(table: pa.Table) -> pa.Table:
        halves = [table.column(name).to_numpy().view(np.uint64) for name in ("first", "second")]
        shard = Shard.build(np.stack(halves, axis=1), table.column("docs").to_numpy())
        return pa.table({
            "shard": table.column("shard").slice(0, 1), "keys": [table.num_rows],
            "levels": [shard.hash.level_sizes.tobytes()], "words": [shard.hash.words.tobytes()],
            "prints": [shard.prints.tobytes()], "counts": [shard.counts.tobytes()],
        }, schema=SHARDS_ARROW)

    high = F.shiftrightunsigned("first", 32)
    number = F.shiftrightunsigned(high * F.lit(shards).cast("long"), 32).cast("long")
    return frequent.withColumn("shard", number).groupBy("shard").applyInArrow(build, SHARDS)


SHARDS_ARROW = pa.schema([
    ("shard", pa.int64()), ("keys", pa.int64()),
    *((name, pa.binary()) for name in ("levels", "words", "prints", "counts")),
])


def load_shard(row) -> Shard:
    made = PerfectHash(np.frombuffer(row.levels, np.int64), np.frombuffer(row.words, np.uint64))
    return Shard(made, np.frombuffer(row.prints, np.uint64), np.frombuffer(row.counts, np.uint32))


def frequent_lines(keys: np.ndarray, index: dict[int, Shard], shards: int, min_docs: int) -> np.ndarray:
    """Which keys the index has in so many documents."""
    numbers = shard_of(keys, shards)
    order = np.argsort(numbers, kind="stable")
    bounds = np.flatnonzero(np.append(True, np.diff(numbers[order]) != 0)).tolist() + [len(keys)]
    frequent = np.zeros(len(keys), bool)
    for start, stop in zip(bounds, bounds[1:], strict=False):
        at = order[start:stop]
        shard = index.get(int(numbers[at[0]])) if len(at) else None
        if shard is not None:
            frequent[at] = shard.count(keys[at]) >= min_docs
    return frequent & keys.any(1)


PROBED = "doc_id bigint, text string, dropped binary"
RESULT = "doc_id bigint, text string, n_lines bigint, n_dropped bigint"


def probe(
    docs: DataFrame, index: dict[int, Shard], shards: int, min_docs: int, min_chars: int, last: bool
) -> DataFrame:
    """The documents ``(doc_id, text, dropped)`` with one round's shards asked about each line.

    ``dropped`` holds a byte per line. The last round leaves the lines out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1):
                lines = [text.encode().split(b"\n") for text in part.column(1).to_pylist()]
                keys = line_hashes([line for of in lines for line in of], min_chars)
                found = frequent_lines(keys, sent.value, shards, min_docs)
                bounds = np.cumsum([0, *map(len, lines)])
                flags = [found[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
                for place, before in enumerate(part.column(2).to_pylist()):
                    if before is not None:
                        flags[place] = flags[place] | np.frombuffer(before, bool)
                if not last:
                    dropped = pa.array([f.tobytes() for f in flags], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), dropped], ["doc_id", "text", "dropped"]
                    )
                    continue
                kept = [
                    b"\n".join(line for line, drop in zip(of, flag.tolist(), strict=True) if not drop)
                    if flag.any() else b"\n".join(of)
                    for of, flag in zip(lines, flags, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([text.decode() for text in kept], pa.string()),
                    pa.array(np.diff(bounds)),
                    pa.array([int(flag.sum()) for flag in flags], pa.int64()),
                ], ["doc_id", "text", "n_lines", "n_dropped"])

    return docs.mapInArrow(task, RESULT if last else PROBED)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS, round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """``(doc_id, text, n_lines, n_dropped)``: each text without the lines that ``min_docs``
    documents or more share, and how many lines it had and lost."""
    frequent = staged(
        count_lines(docs, text_col, min_chars).where(F.col("docs") >= min_docs), "line-counts"
    )
    shards = max(1, -(-frequent.count() // shard_keys))
    index = staged(build_index(frequent, shards), "line-index")
    per_round = max(1, round_bytes // (shard_keys * KEY_BYTES))
    left = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"),
        F.lit(None).cast("binary").alias("dropped"),
    )
    for start in range(0, shards, per_round):
        rows = index.where(F.col("shard").between(start, start + per_round - 1)).collect()
        last = start + per_round >= shards
        left = probe(left, {row.shard: load_shard(row) for row in rows}, shards, min_docs, min_chars, last)
        left = left if last else staged(left, "line-round")
    return left
