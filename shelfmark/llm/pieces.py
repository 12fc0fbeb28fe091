"""SentencePiece encoding and decoding with the tokenizers library.

The model's protobuf is parsed here; its normaliser, space marker, piece scores and byte
fallback are rebuilt as a tokenizer of that library. Texts are cut into segments that no
piece crosses, distinct segments are encoded in multithreaded batches. To verify parity each
distinct segment is also encoded by the original library, and so is every raw text, whole.

Defined results: a null or empty text has no ids and decodes to the empty text. Strings of
control tokens in a text are ordinary text. Repeated rows are encoded each. An empty table gives
an empty result; texts of any length are encoded whole. Only id and text are read.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import whole
from shelfmark.llm.segments import SegmentEncoder, marked_starts

MODEL = "piece_bpe_32k.model"
MARKER = "▁"
# Kinds of models and pieces in the protobuf.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: A normaliser message with both its settings off.
AS_IT_IS = bytes([3 << 3 | 2, 4, 3 << 3, 0, 4 << 3, 0])


@dataclass
class PieceModel:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    unknown: int = 0
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True
    space_as_suffix: bool = False


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protobuf message: number, and an integer or the raw bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(wire)
            if size is None:
                size = varint()
            yield number, data[at : at + size]
            at += size


def parse_model(data: bytes) -> PieceModel:
    """Read pieces, trainer and normaliser settings from a model file's bytes."""
    model = PieceModel()
    for number, value in fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for part, content in fields(value):
                if part == 1:
                    piece = content.decode()
                elif part == 2:
                    (score,) = struct.unpack("<f", content)
                elif part == 3:
                    kind = content
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for part, content in fields(value):
                if part == 3:
                    model.kind = content
                elif part == 24:
                    model.space_as_suffix = bool(content)
                elif part == 35:
                    model.byte_fallback = bool(content)
                elif part == 40:
                    model.unknown = content
        elif number == 3:
            for part, content in fields(value):
                if part == 2:
                    model.charsmap = content
                elif part == 3:
                    model.dummy_prefix = bool(content)
                elif part == 4:
                    model.remove_extra_spaces = bool(content)
                elif part == 5:
                    model.escape_spaces = bool(content)
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    if model.space_as_suffix or not model.escape_spaces:
        raise ValueError("models without a space marker before words are not supported")
    if any(kind == USER_DEFINED for _, _, kind in model.pieces):
        raise ValueError("models with user-defined pieces are not supported")
    return model


def merges_of(model: PieceModel) -> list[tuple[str, str]]:
    """The pairs that make a piece, best score of the piece first."""
    usable = {piece: score for piece, score, kind in model.pieces if kind == NORMAL}
    merges = [
        (-usable[piece], place, piece[:cut], piece[cut:])
        for place, piece in enumerate(usable)
        for cut in range(1, len(piece))
        if piece[:cut] in usable and piece[cut:] in usable
    ]
    return [(left, right) for _, _, left, right in sorted(merges)]


def rebuild(model: PieceModel):
    """The model as a tokenizer that takes raw text."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unknown = next(
        (place for place, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN), model.unknown
    )
    if model.kind == UNIGRAM:
        core = models.Unigram(
            [(piece, score) for piece, score, _ in model.pieces], unknown, model.byte_fallback
        )
    else:
        core = models.BPE(
            vocab={piece: place for place, (piece, _, _) in enumerate(model.pieces)},
            merges=merges_of(model), unk_token=model.pieces[unknown][0], fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARKER))
    steps.append(normalizers.Replace(" ", MARKER))
    tokenizer.normalizer = normalizers.Sequence(steps)
    undo = [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        undo.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(undo)
    return tokenizer


class PieceEncoder:
    """Ids of texts, with the number of segments whose ids the original library differs on."""

    def __init__(self, path: str | None = None, verify: bool = True):
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(MODEL)
        with open(path, "rb") as file:
            data = file.read()
        self.model = parse_model(data)
        self.tokenizer = rebuild(self.model)
        self.normalizer = self.tokenizer.normalizer
        # Segments come with their markers in place, so nothing is left to normalise.
        self.tokenizer.normalizer = None
        self.original = None
        if verify:
            import sentencepiece

            self.complete = sentencepiece.SentencePieceProcessor(model_proto=data)
            # A message given twice is merged: the same model without prefix and trimming.
            self.original = sentencepiece.SentencePieceProcessor(model_proto=data + AS_IT_IS)
        self.differing = 0
        self.checked = 0
        self.segments = SegmentEncoder(marked_starts, self._encode)
        self.plain = not self.model.charsmap and not self.model.remove_extra_spaces
        self.splittable = not any(
            MARKER in piece[1:] and piece.strip(MARKER) for piece, _, _ in self.model.pieces
        )

    def _encode(self, segments: list[str]) -> list[list[int]]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]
        if self.original is not None:
            expected = self.original.encode([s.replace(MARKER, " ") for s in segments], num_threads=1)
            self.differing += sum(a != b for a, b in zip(found, expected, strict=True))
            self.checked += len(segments)
        return found

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        if self.plain:
            return (MARKER if self.model.dummy_prefix else "") + text.replace(" ", MARKER)
        return self.normalizer.normalize_str(text)

    def __call__(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        ready = [self.normalise(text) for text in texts]
        if self.splittable:
            yield from self.segments(ready)
        else:
            for ids in self._encode(ready):
                yield np.array(ids, np.uint32)


    def parity(self, texts: Sequence[str], ids: Sequence[np.ndarray]) -> list[bool]:
        """Whether each text's ids are the original's for the whole raw text, normaliser and
        marker included."""
        return [self.complete.encode(t) == i.tolist() for t, i in zip(texts, ids, strict=True)]


class PieceDecoder:
    """Texts of ids by gathering the bytes of their pieces."""

    def __init__(self, model: PieceModel):
        parts = []
        for piece, _, kind in model.pieces:
            if kind == BYTE:
                parts.append(bytes([int(piece[3:5], 16)]))
            elif kind in (CONTROL, UNKNOWN):
                parts.append(b"" if kind == CONTROL else " ⁇ ".encode())
            else:
                parts.append(piece.replace(MARKER, " ").encode())
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.sizes = np.array([len(part) for part in parts], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.prefix = model.dummy_prefix

    def __call__(self, ids: np.ndarray) -> str:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return ""
        data = self.data[
            np.repeat(self.offsets[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]))
        ].tobytes()
        return data[1 if self.prefix and data[:1] == b" " else 0 :].decode("utf-8", "replace")


ENCODED = "doc_id bigint, ids array<int>, n_ids bigint, round_trip boolean, parity boolean"
_ENCODERS: dict[str | None, PieceEncoder] = {}


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None
) -> DataFrame:
    """One row per document: its ids, and whether they decode to the text.

    ``parity`` tells that the original library gives the same ids for the whole text; every text
    is compared. One pass without a shuffle; batches are encoded with as many threads as Spark
    gives a task.
    """
    threads = docs.sparkSession.conf.get("spark.task.cpus", "1")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["RAYON_NUM_THREADS"] = threads
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if int(threads) > 1 else "false"
        if model not in _ENCODERS:
            _ENCODERS[model] = PieceEncoder(model)
        encoder = _ENCODERS[model]
        decoder = PieceDecoder(encoder.model)
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                texts = part.column(1).to_pylist()
                ids = list(encoder(texts))
                same = encoder.parity(texts, ids)
                back = [decoder(row) == text for row, text in zip(ids, texts, strict=True)]
                offsets = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                    pa.array(np.diff(offsets)), pa.array(back), pa.array(same, pa.bool_()),
                ], ["doc_id", "ids", "n_ids", "round_trip", "parity"])

    return docs.select(
        F.col(id_col).cast("long"), whole(F.col(text_col)).alias("text")
    ).mapInArrow(task, ENCODED)


def decode_documents(
    encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None
) -> DataFrame:
    """The id and text of each row of ids; null ids give an empty text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _ENCODERS:
            _ENCODERS[model] = PieceEncoder(model)
        decoder = PieceDecoder(_ENCODERS[model].model)
        for batch in batches:
            rows = batch.column(1).to_pylist()
            texts = [decoder(np.array(row or [], np.int64)) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return encoded.select(F.col(id_col).cast("long"), F.col(ids_col)).mapInArrow(
        task, "doc_id bigint, text string"
    )
