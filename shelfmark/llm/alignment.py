"""Alignment of two tokenizers over the same texts, with corpus-wide counts of linked id pairs.

Rows are brought together by their full text, so that each distinct text is tokenized and
aligned once; its pairs count as often as rows hold it. Tokens of both sides are cut into
groups where both end at the same byte; a link is a token of each side within one group.

Texts are aligned in slices of a few megabytes. A slice keeps its distinct pairs once, with
the documents that hold them, and its texts refer to these by number. Only a slice's distinct
pairs are counted over the corpus and joined with the counts, not each text's links, so the
shuffle grows with the slices, and a pair that is everywhere is a row per slice. What is
measured per text is joined back to the rows by a digest of the text.

Defined results: a null or empty text, and one whose bytes either side's tokens don't give
back, has no tokens: zeros and an empty digest. Strings of special tokens in a text are plain
text. Repeated rows are documents each and get the same measures; so do rows without an id. An
empty table gives an empty result. A text of any length is aligned whole; in a group, equal
ids are counted, not listed, so a long stretch without a common end takes no square of its
length. Only the id and the text are read, whatever other columns are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import staged, whole
from shelfmark.llm.packing import TOKENIZER, byte_signs
from shelfmark.llm.pieces import BYTE, CONTROL, MARKER, MODEL, PieceEncoder, PieceModel, UNKNOWN
from shelfmark.llm.segments import SegmentEncoder, word_starts
from shelfmark.llm.shingles import byte_slices
from shelfmark.operators.joins import skew_join

#: Bytes of text aligned at a time.
SLICE = 1 << 20
#: Slices in one task's number range.
TASK_BITS = 32


class Vocabulary:
    """The bytes of every id of one side."""

    def __init__(self, entries: list[bytes]):
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.sizes = np.array([len(entry) for entry in entries], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.followed = {sign: np.array([f"{n}{sign}" for n in range(len(entries))], object) for sign in ",|;"}

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[np.repeat(self.offsets[ids] - (ends - sizes), sizes) + np.arange(total)]


def byte_level_side(path: str | None = None) -> tuple[SegmentEncoder, Vocabulary]:
    """Ids and bytes of a byte-level BPE file; strings of its special tokens are plain text."""
    from tokenizers import Tokenizer

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    model, signs = tokenizer.model, byte_signs()
    back = {ord(signs.get(byte, chr(byte))): byte for byte in range(256)}

    def encode(segments: list[str]) -> list[list[int]]:
        mapped = (s.encode().decode("latin-1").translate(signs) for s in segments)
        return [[token.id for token in model.tokenize(segment)] for segment in mapped]

    entries = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for entry, number in tokenizer.get_vocab(with_added_tokens=True).items():
        if all(ord(sign) in back for sign in entry):
            entries[number] = bytes(back[ord(sign)] for sign in entry)
    return SegmentEncoder(word_starts, encode), Vocabulary(entries)


def piece_bytes(model: PieceModel) -> Vocabulary:
    """The bytes of every piece; those of no text's bytes, like the unknown piece, have none."""
    return Vocabulary([
        bytes([int(piece[3:5], 16)]) if kind == BYTE
        else b"" if kind in (CONTROL, UNKNOWN)
        else piece.replace(MARKER, " ").encode()
        for piece, _, kind in model.pieces
    ])


class Sides:
    """Both tokenizers, as the texts of a slice go through them."""

    def __init__(self, first: str | None = None, second: str | None = None):
        if second is None:
            import public_tokenizers

            second = public_tokenizers.path(MODEL)
        self.encode_first, self.first = byte_level_side(first)
        self.encode_second = PieceEncoder(second, verify=False)
        self.second = piece_bytes(self.encode_second.model)


_SIDES: dict[tuple[str | None, str | None], Sides] = {}


def kept_sides(first: str | None, second: str | None) -> Sides:
    """One pair of tokenizers for all tasks of a Python worker."""
    if (first, second) not in _SIDES:
        _SIDES[first, second] = Sides(first, second)
    return _SIDES[first, second]


@dataclass
class Aligned:
    """The alignment of some texts; each text's pairs are ``entries[bounds[t]:bounds[t + 1]]``."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    bounds: np.ndarray
    entries: np.ndarray
    times: np.ndarray


def sums(values: np.ndarray, owners: np.ndarray, count: int) -> np.ndarray:
    """Sums by owner, for owners in ascending order."""
    before = np.append(0, np.cumsum(values))
    bounds = np.searchsorted(owners, np.arange(count + 1))
    return before[bounds[1:]] - before[bounds[:-1]]


def common_values(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The distinct values that two ascending arrays have in common."""
    distinct = first[np.append(True, first[1:] != first[:-1])[: len(first)]]
    if not len(second):
        return second
    at = np.minimum(np.searchsorted(second, distinct), len(second) - 1)
    return distinct[second[at] == distinct]


def given_back(ids: np.ndarray, counts: np.ndarray, side: Vocabulary, texts: list[bytes]) -> np.ndarray:
    """Whether the bytes of each text's ids are the text's."""
    owners = np.repeat(np.arange(len(texts)), counts)
    lengths = np.array([len(text) for text in texts], np.int64)
    same = sums(side.sizes[ids], owners, len(texts)) == lengths
    made = side.bytes_of(ids[same[owners]])
    expected = np.frombuffer(b"".join(t for t, ok in zip(texts, same.tolist(), strict=True) if ok), np.uint8)
    wrong = np.flatnonzero(made != expected)
    ends = np.cumsum(lengths[same])
    same[np.flatnonzero(same)[np.searchsorted(ends, wrong, "right")]] = False
    return same


def distinct_in_groups(groups: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ids of each group, by group, and how often the group has them."""
    keys, times = np.unique(groups.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64), return_counts=True)
    return (keys >> np.uint64(32)).astype(np.int64), keys & np.uint64(0xFFFFFFFF), times


def crossed(
    groups_a: np.ndarray, ids_a: np.ndarray, groups_b: np.ndarray, ids_b: np.ndarray, count: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of ids of each group: group, pair, and the links it stands for."""
    size_a, size_b = np.bincount(groups_a, minlength=count), np.bincount(groups_b, minlength=count)
    single = (size_a == 1) & (size_b == 1)
    pairs = [ids_a[single[groups_a]].astype(np.uint64) << np.uint64(32) | ids_b[single[groups_b]].astype(np.uint64)]
    owners, times = [np.flatnonzero(single)], [np.ones(int(single.sum()), np.int64)]
    if not single.all():
        more_a, more_b = ~single[groups_a], ~single[groups_b]
        ga, ia, ta = distinct_in_groups(groups_a[more_a], ids_a[more_a])
        gb, ib, tb = distinct_in_groups(groups_b[more_b], ids_b[more_b])
        starts_b = np.searchsorted(gb, ga)
        width = np.searchsorted(gb, ga, "right") - starts_b
        left = np.repeat(np.arange(len(ga)), width)
        right = np.repeat(starts_b - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        owners.append(ga[left])
        pairs.append(ia[left] << np.uint64(32) | ib[right])
        times.append(ta[left] * tb[right])
    return np.concatenate(owners), np.concatenate(pairs), np.concatenate(times)


def aligned(texts: list[str], sides: Sides) -> Aligned:
    """Tokenize and align texts, none of them empty."""
    spaced = [" " + text for text in texts]
    raw = [text.encode() for text in spaced]
    ids, counts = [], []
    for encode, given in ((sides.encode_first, spaced), (sides.encode_second, texts)):
        found = list(encode(given))
        ids.append(np.concatenate(found).astype(np.int64))
        counts.append(np.array([len(one) for one in found], np.int64))
    vocabularies = (sides.first, sides.second)
    whole_texts = np.logical_and.reduce([
        given_back(i, c, side, raw) for i, c, side in zip(ids, counts, vocabularies, strict=True)
    ])
    numbers = np.arange(len(texts))
    owners = []
    for place in range(2):
        of = np.repeat(numbers, counts[place])
        keep = whole_texts[of]
        ids[place], owners_kept = ids[place][keep], of[keep]
        counts[place] = np.where(whole_texts, counts[place], 0)
        owners.append(owners_kept)
    # Both sides give the same bytes, so ends are comparable over all texts at once. A token
    # without bytes would end where the one before does, and stays in that one's group.
    ends = [np.cumsum(side.sizes[i]) for i, side in zip(ids, vocabularies, strict=True)]
    cuts = common_values(*ends)
    groups_a, groups_b = (np.searchsorted(cuts, e) for e in ends)
    group_owner = np.zeros(len(cuts), np.int64)
    group_owner[groups_a] = owners[0]
    by_group, pair, times = crossed(groups_a, ids[0], groups_b, ids[1], len(cuts))
    pairs, numbered = np.unique(pair, return_inverse=True)
    keys, inverse = np.unique(
        group_owner[by_group].astype(np.uint64) << np.uint64(32) | numbered.astype(np.uint64),
        return_inverse=True,
    )
    total = np.bincount(inverse, times, len(keys)).astype(np.int64)
    owner = (keys >> np.uint64(32)).astype(np.int64)
    return Aligned(
        counts[0], counts[1], np.bincount(group_owner, minlength=len(texts)),
        sums(total, owner, len(texts)),
        group_texts(ids, (groups_a, groups_b), owners, vocabularies, len(texts)),
        pairs, np.searchsorted(owner, np.arange(len(texts) + 1)),
        (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), total,
    )


def group_texts(ids, groups, owners, vocabularies, count: int) -> list[str]:
    """Each text's groups as ``a1,a2|b1;a3|b2``."""
    starts = [np.searchsorted(groups[1 - side], groups[side], "left" if side == 0 else "right") for side in (0, 1)]
    parts = np.empty(len(ids[0]) + len(ids[1]), object)
    places = np.zeros(len(parts), np.int64)
    for side, closing in ((0, "|"), (1, ";")):
        at = np.arange(len(ids[side])) + starts[side]
        ends = np.append(groups[side][1:] != groups[side][:-1], True)[: len(at)]
        followed = vocabularies[side].followed
        parts[at[~ends]] = followed[","][ids[side][~ends]]
        parts[at[ends]] = followed[closing][ids[side][ends]]
        places[at] = owners[side]
    bounds = np.searchsorted(places, np.arange(count + 1)).tolist()
    listed = parts.tolist()
    return ["".join(listed[a:b])[:-1] for a, b in zip(bounds, bounds[1:], strict=False)]


SLICES = (
    "slice bigint, texts array<binary>, rows array<bigint>, n_a array<bigint>, n_b array<bigint>, "
    "n_groups array<bigint>, n_links array<bigint>, groups_sha256 array<string>, "
    "bounds array<bigint>, entries array<int>, times array<bigint>, "
    "pairs array<bigint>, docs array<bigint>"
)
SLICE_NAMES = [field.split()[0] for field in SLICES.split(", ")]


def align_texts(
    texts: DataFrame, first: str | None, second: str | None, slice_bytes: int = SLICE
) -> DataFrame:
    """One row per slice of the distinct texts ``(text, rows)``; ``docs`` are the rows by pair."""

    def packed(number: int, part: pa.RecordBatch, sides: Sides) -> pa.RecordBatch:
        texts, rows = part.column(0).to_pylist(), part.column(1).to_numpy()
        found = aligned(texts, sides)
        owners = np.repeat(np.arange(len(texts)), np.diff(found.bounds))
        docs = np.bincount(found.entries, rows[owners], len(found.pairs)).astype(np.int64)
        digests = [
            hashlib.sha256(groups.encode()).hexdigest() if groups else "" for groups in found.groups
        ]
        columns = [
            pa.array([hashlib.sha256(text.encode()).digest() for text in texts], pa.binary()),
            part.column(1), found.n_a, found.n_b, found.n_groups, found.n_links,
            pa.array(digests, pa.string()), found.bounds, found.entries.view(np.int32), found.times,
            found.pairs.view(np.int64), docs,
        ]
        arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in arrays]
        return pa.RecordBatch.from_arrays([pa.array([number]), *lists], SLICE_NAMES)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << TASK_BITS
        for batch in batches:
            for part in byte_slices(batch, 0, slice_bytes):
                yield packed(number, part, kept_sides(first, second))
                number += 1

    return texts.mapInArrow(task, SLICES)


def pair_counts(slices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each slice's distinct pairs ``(slice, place, pair, docs)``; and ``(pair, count, best)``
    over the corpus: the documents that hold a pair, and whether its first id has no better."""
    entries = slices.select(
        "slice", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "_entry")
    ).select("slice", "place", F.col("_entry.pairs").alias("pair"), F.col("_entry.docs").alias("docs"))
    counts = staged(
        entries.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", 32)),
        "alignment-counts",
    )
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    best = skew_join(counts, most, ["a"], "inner").select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best")
    )
    return entries.select("slice", "place", "pair"), best


MEASURES = (
    "text_key binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)
MEASURE_NAMES = [field.split()[0] for field in MEASURES.split(", ")]


def measure(slices: DataFrame, counted: DataFrame) -> DataFrame:
    """The measures of each distinct text, from the slices and the counts of their pairs
    ``(slice, counts)``, in the order of the slice's pairs."""
    rows = slices.drop("rows", "pairs", "docs").join(counted, "slice", "left")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(len(batch)):
                row = {name: batch.column(name)[place].values for name in batch.schema.names if name != "slice"}
                bounds, entries, times = (row[n].to_numpy() for n in ("bounds", "entries", "times"))
                counts = row["counts"]
                if counts is None:
                    count = best = np.zeros(0, np.int64)
                else:
                    count = counts.field("count").to_numpy()
                    best = counts.field("best").to_numpy(zero_copy_only=False).astype(np.int64)
                by_text = [
                    np.diff(np.append(0, np.cumsum(times * value[entries]))[bounds]) for value in (best, count)
                ]
                yield pa.RecordBatch.from_arrays([
                    row["texts"], row["n_a"], row["n_b"], row["n_groups"], row["n_links"],
                    *map(pa.array, by_text), row["groups_sha256"],
                ], MEASURE_NAMES)

    return rows.mapInArrow(task, MEASURES)


def align_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    first: str | None = None, second: str | None = None, slice_bytes: int = SLICE,
) -> DataFrame:
    """One row per document: ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups_sha256``, for the tokenizer files ``first`` and ``second``."""
    text = whole(F.col(text_col))
    texts = (
        docs.select(text.alias("text")).where("text <> ''")
        .groupBy("text").agg(F.count("*").alias("rows"))
    )
    slices = staged(align_texts(texts, first, second, slice_bytes), "alignment-slices")
    entries, counts = pair_counts(slices)
    # A slice has no more distinct pairs than links, so its row stays within the slice's bound.
    counted = skew_join(entries, counts, ["pair"], "inner").groupBy("slice").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "count", "best"))),
            lambda one: F.struct(one["count"].alias("count"), one["best"].alias("best")),
        ).alias("counts")
    )
    measures = measure(slices, counted)
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.when(text != "", F.unhex(F.sha2(text, 256))).alias("text_key"),
    )
    zeros = {name: F.coalesce(name, F.lit(0).cast("long")) for name in MEASURE_NAMES[1:-1]}
    return skew_join(keyed, measures, ["text_key"], "left").select(
        "doc_id", *(value.alias(name) for name, value in zeros.items()),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
