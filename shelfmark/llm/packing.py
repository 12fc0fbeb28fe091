"""Cost-balanced packing of token ids into sequences.

The cost of a piece of ``l`` tokens is ``l + l * l / balance``: work linear in its tokens
plus attention within the piece. Documents go, longest first, to the sequence of least cost
with room for them, and are cut only where none has. Order and balance hold within a window of
``WINDOW_TOKENS`` tokens of the documents that one task reads.

Defined results: a null or empty text has just the closing id. Repeated rows are packed each
on its own. Special tokens' strings in a text are encoded as the tokenizer does by default.
An empty table gives no pieces. A text of any length is encoded whole, in parts that no token
crosses. Only the id and the text are read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.segments import SegmentEncoder, word_starts
from shelfmark.llm.shingles import byte_slices

CAPACITY = 1024
#: Tokens at which attention costs as much as the linear part.
BALANCE = 4096
#: Tokens packed at a time; a task holds one window and the batch being read.
WINDOW_TOKENS = 1 << 20
CLOSING_ID = 0
TOKENIZER = "byte_bpe_50k.json"
TASK_BITS = 36


@dataclass(frozen=True)
class Piece:
    document: int
    start: int
    length: int
    sequence: int
    offset: int


def room_of(total: int, capacity: int) -> list[int]:
    """Lengths of the sequences: all full, and the rest in powers of two, which need no padding."""
    rest = total % capacity
    tail = [1 << bit for bit in range(rest.bit_length()) if rest >> bit & 1]
    return [capacity] * (total // capacity) + tail[::-1]


def cost(length: int, balance: int = BALANCE) -> float:
    return length + length * length / balance


class OpenSequences:
    """Sequences with room left: finds the one of least cost among those with enough.

    Sequences of the same room are in a heap by cost; over the rooms stands a tree whose nodes
    hold the least of all sequences below.
    """

    NONE = (float("inf"), -1, 0)

    def __init__(self, capacity: int):
        self.heaps: list[list[tuple[float, int, int]]] = [[] for _ in range(capacity + 1)]
        self.width = 1 << capacity.bit_length()
        self.least = [self.NONE] * (2 * self.width)

    def _refresh(self, room: int) -> None:
        at = self.width + room
        self.least[at] = self.heaps[room][0] if self.heaps[room] else self.NONE
        while at > 1:
            at >>= 1
            self.least[at] = min(self.least[2 * at], self.least[2 * at + 1])

    def put(self, room: int, spent: float, sequence: int) -> None:
        heapq.heappush(self.heaps[room], (spent, sequence, room))
        self._refresh(room)

    def take(self, room: int) -> tuple[float, int, int] | None:
        """Remove and give ``(spent, sequence, room)`` of least cost with so much room."""
        found = self.NONE
        low, high = self.width + room, 2 * self.width
        while low < high:
            if low & 1:
                found = min(found, self.least[low])
                low += 1
            if high & 1:
                high -= 1
                found = min(found, self.least[high])
            low >>= 1
            high >>= 1
        if found is self.NONE:
            return None
        heapq.heappop(self.heaps[found[2]])
        self._refresh(found[2])
        return found


def pack(lengths: Sequence[int], capacity: int = CAPACITY, balance: int = BALANCE) -> list[Piece]:
    """Place documents of these lengths; together the pieces fill every sequence.

    A document no longer than a sequence is cut only if no sequence has room for all of it.
    """
    room = room_of(sum(lengths), capacity)
    open_ = OpenSequences(capacity)
    for sequence, size in enumerate(room):
        open_.put(size, 0.0, sequence)
    waiting = [(-length, document, 0) for document, length in enumerate(lengths) if length]
    heapq.heapify(waiting)
    pieces = []
    while waiting:
        negative, document, start = heapq.heappop(waiting)
        length = -negative
        spent, sequence, left = open_.take(min(length, capacity)) or open_.take(1)
        size = min(length, left)
        pieces.append(Piece(document, start, size, sequence, room[sequence] - left))
        if size < left:
            open_.put(left - size, spent + cost(size, balance), sequence)
        if size < length:
            heapq.heappush(waiting, (size - length, document, start + size))
    return pieces


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the code points from 256 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(256 + number) for number, byte in enumerate(others)}


def tokenizer_ids(path: str | None = None) -> SegmentEncoder:
    """Ids of a byte-level BPE tokenizer file, without special tokens added."""
    from tokenizers import Tokenizer

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]

    signs = byte_signs()
    model = tokenizer.model

    def encode(segments: list[str]) -> list[list[int]]:
        mapped = (s.encode().decode("latin-1").translate(signs) for s in segments)
        return [[token.id for token in model.tokenize(segment)] for segment in mapped]

    by_segment = SegmentEncoder(word_starts, encode)

    def ids(texts: Sequence[str]) -> Iterator[np.ndarray]:
        plain = [not any(token in text for token in special) for text in texts]
        found = by_segment([text for text, is_plain in zip(texts, plain, strict=True) if is_plain])
        for text, is_plain in zip(texts, plain, strict=True):
            if is_plain:
                yield next(found)
            else:
                yield np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    return ids


SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
NAMES = [field.split()[0] for field in SCHEMA.split(", ")]


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    window_tokens: int = WINDOW_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece; with ``with_ids`` also its token ids.

    Every task packs the documents it reads, a window at a time, so no text and no id is
    shuffled. A sequence's number holds the task's partition, so a task that is run again
    gives the same rows.
    """
    schema = SCHEMA + (", ids array<int>" if with_ids else "")

    def rows_of(window: list[tuple[int | None, np.ndarray]], base: int) -> tuple[pa.RecordBatch, int]:
        pieces = pack([len(ids) for _, ids in window], capacity)
        rows = []
        for piece in pieces:
            number, ids = window[piece.document]
            part = ids[piece.start : piece.start + piece.length]
            row = [
                number, piece.start, piece.length, zlib.crc32(part.astype("<u4").tobytes()),
                len(ids), base + piece.sequence, piece.offset,
            ]
            rows.append(row + [part.astype(np.int32)] if with_ids else row)
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(column, pa.int64()) for column in columns[: len(NAMES)]]
        if with_ids:
            arrays.append(pa.array(columns[-1], pa.list_(pa.int32())))
        names = [*NAMES, "ids"][: len(arrays)]
        made = max(piece.sequence for piece in pieces) + 1
        return pa.RecordBatch.from_arrays(arrays, names), base + made

    def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        base = TaskContext.get().partitionId() << TASK_BITS
        window, tokens = [], 0
        for batch in batches:
            if encode is None:
                encode = kept_tokenizer(tokenizer)
            for part in byte_slices(batch, 1):
                numbers = part.column(0).to_pylist()
                texts = part.column(1).to_pylist()
                for number, ids in zip(numbers, encode(texts), strict=True):
                    closed = np.append(ids, np.uint32(CLOSING_ID))
                    window.append((number, closed))
                    tokens += len(closed)
                    if tokens >= window_tokens:
                        made, base = rows_of(window, base)
                        yield made
                        window, tokens = [], 0
        if window:
            yield rows_of(window, base)[0]

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long"), text.alias("text")).mapInArrow(pack_task, schema)


_TOKENIZERS: dict[str | None, object] = {}


def kept_tokenizer(path: str | None):
    """One tokenizer with its known segments for all tasks of a Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = tokenizer_ids(path)
    return _TOKENIZERS[path]
