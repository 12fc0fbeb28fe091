import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings as hypothesis_settings, strategies as st
from tokenizers import Tokenizer

from conftest import LONG, LONG_WORD, ROWS
from shelfmark.llm import packing, pieces
from shelfmark.llm.segments import HashPlaces, cut_long

ODD = [
    "it's we're don't 'tis  'S x''s y'll'd 've'verb '", "a  b\n\n c \t\n", "   ", "", "\n",
    "x <|endoftext|> y", "日本語 テキスト ½ ² 12ab", "a b c", "'s", " 's", "a're're", " '",
    "<s> </s> <unk>", "tab\tnew\nline 123 4567", "é ñ 😀", LONG[:60_000], LONG_WORD[:20_000],
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


@pytest.fixture(scope="module")
def by_segment():
    return packing.tokenizer_ids()


@pytest.fixture(scope="module")
def piece_encoder():
    return pieces.PieceEncoder()


@pytest.fixture(scope="module")
def original():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


def test_segment_ids_are_the_tokenizers(plain, by_segment, piece_encoder, original):
    for text, ids in zip(ODD, by_segment(ODD), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text[:60]
    for text, ids in zip(ODD, piece_encoder(ODD), strict=True):
        assert ids.tolist() == original.encode(text), text[:60]
    assert piece_encoder.differing == 0


SIGNS = st.text(st.sampled_from("ab é'sretvlmd  \n\t12.,!日▁<"), max_size=40)


@hypothesis_settings(max_examples=300, deadline=None)
@given(st.lists(SIGNS, min_size=1, max_size=6))
def test_any_texts(plain, by_segment, piece_encoder, original, texts):
    for text, ids in zip(texts, by_segment(texts), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    decode = pieces.PieceDecoder(piece_encoder.model)
    for text, ids in zip(texts, piece_encoder(texts), strict=True):
        assert ids.tolist() == original.encode(text)
        assert decode(ids) == original.decode(ids.tolist()) == text.replace("▁", " ")


def test_long_texts_are_cut_between_segments():
    parts = list(cut_long(LONG, 1000))
    assert "".join(parts) == LONG and len(parts) > 50


def test_hash_places_under_collisions():
    places = HashPlaces(64)
    hashes = np.arange(1, 65, dtype=np.uint64) * np.uint64(256)
    places.add(hashes, 0)
    assert places.find(hashes).tolist() == list(range(64))
    assert places.find(hashes + np.uint64(1)).tolist() == [-1] * 64


def power_of_two(n):
    return n & (n - 1) == 0


def check_packing(rows, ids_of):
    """Every id in one piece; sequences gapless, full or a power of two."""
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        documents.setdefault(r.doc_id, []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == 1024 or at < 1024 and power_of_two(at)
    assert set(documents) == set(ids_of)
    for number, parts in documents.items():
        ids, at = [*ids_of[number], 0], 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            part = np.array(ids[at : at + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(ids)


def test_packing_documents(documents, texts, plain):
    rows = packing.pack_documents(documents, window_tokens=50_000).collect()
    check_packing(rows, {n: plain.encode(t, add_special_tokens=False).ids for n, t in texts.items()})


def test_packing_edges(edge_docs, empty_docs, plain):
    rows = packing.pack_documents(edge_docs).collect()
    single = {n: t or "" for n, t in ROWS if n not in (None, 7)}
    total = sum(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ROWS)
    assert sum(r.length for r in rows) == total
    assert {r.doc_id for r in rows} == {n for n, _ in ROWS}
    for number in single:
        parts = sorted((r for r in rows if r.doc_id == number), key=lambda r: r.start)
        assert sum(r.length for r in parts) == parts[0].doc_tokens
    with_ids = packing.pack_documents(edge_docs, with_ids=True).where("doc_id = 2").collect()
    assert [list(r.ids) for r in with_ids] == [[0]]
    assert packing.pack_documents(empty_docs).count() == 0


@hypothesis_settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 3000), max_size=60))
def test_pack_fills_every_sequence(lengths):
    found = packing.pack(lengths)
    room = packing.room_of(sum(lengths), 1024)
    used = {}
    for p in found:
        used.setdefault(p.sequence, []).append((p.offset, p.length))
    assert [sum(n for _, n in used[s]) for s in range(len(room))] == room


def test_costs_are_balanced():
    rng = np.random.default_rng(0)
    lengths = np.minimum(rng.lognormal(5, 1, 2000).astype(int) + 1, 900).tolist()
    found = packing.pack(lengths)
    costs = {}
    for p in found:
        costs[p.sequence] = costs.get(p.sequence, 0) + packing.cost(p.length)
    full = [costs[s] for s, room in enumerate(packing.room_of(sum(lengths), 1024)) if room == 1024]
    in_order = [sum(packing.cost(n) for n in lengths[i : i + 5]) for i in range(0, len(lengths) - 5, 5)]
    assert np.std(full) / np.mean(full) < 0.5 * np.std(in_order) / np.mean(in_order)


def test_encoding_and_decoding_documents(documents, texts, original):
    encoded = pieces.encode_documents(documents)
    rows = encoded.collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert list(r.ids) == original.encode(texts[r.doc_id]) and r.n_ids == len(r.ids)
        assert r.round_trip and r.parity
    decoded = pieces.decode_documents(encoded)
    assert {r.doc_id: r.text for r in decoded.collect()} == texts


def test_encoding_edges(edge_docs, empty_docs, original):
    rows = pieces.encode_documents(edge_docs).collect()
    assert sorted(str((r.doc_id, list(r.ids))) for r in rows) == sorted(
        str((n, original.encode(t or ""))) for n, t in ROWS
    )
    assert pieces.encode_documents(empty_docs).count() == 0
    assert pieces.decode_documents(pieces.encode_documents(empty_docs)).count() == 0


def message(number, content):
    return bytes([number << 3 | 2]) + length(len(content)) + content


def length(n):
    return bytes([n]) if n < 128 else bytes([n & 0x7F | 0x80]) + length(n >> 7)


def test_a_unigram_model_is_rebuilt():
    """A model written by hand, as no tokenizer is trained here."""
    listed = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    listed += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    listed += [("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.1, 1), ("▁ab", -3.5, 1), ("ab", -4.0, 1),
               ("ba", -3.9, 1), ("▁a", -3.2, 1)]
    data = b"".join(
        message(1, message(1, piece.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + bytes([3 << 3, kind]))
        for piece, score, kind in listed
    )
    trainer = bytes([3 << 3, 1]) + length(35 << 3) + b"\x01"
    data += message(2, trainer) + message(3, message(1, b"identity") + bytes([4 << 3, 0]))
    model = pieces.parse_model(data)
    assert model.kind == pieces.UNIGRAM and model.byte_fallback and len(model.pieces) == len(listed)
    rebuilt = pieces.rebuild(model)
    original = sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in ("ab", "abab ab", "baab", "b a  ab", "a日b", "xyz"):
        assert rebuilt.encode(text, add_special_tokens=False).ids == original.encode(text)
        assert pieces.PieceDecoder(model)(np.array(original.encode(text))) == text


def placed_one_by_one(lengths, capacity):
    """Descending documents, each to the cheapest sequence that holds it, by looking at all."""
    room = packing.room_of(sum(lengths), capacity)
    left, spent = list(room), [0.0] * len(room)
    waiting = sorted((-n, d, 0) for d, n in enumerate(lengths))
    pieces = []
    while waiting:
        n, d, start = waiting.pop(0)
        fits = [s for s in range(len(room)) if left[s] >= min(-n, capacity)]
        s = min(fits or [s for s in range(len(room)) if left[s]], key=lambda s: (spent[s], s))
        size = min(-n, left[s])
        pieces.append((d, start, size, s))
        left[s] -= size
        spent[s] += packing.cost(size)
        if size < -n:
            waiting = sorted([*waiting, (n + size, d, start + size)])
    return pieces


@hypothesis_settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 150), max_size=50))
def test_pack_finds_the_cheapest_sequence_with_room(lengths):
    found = [(p.document, p.start, p.length, p.sequence) for p in packing.pack(lengths, capacity=64)]
    assert found == placed_one_by_one(lengths, 64)


def test_parity_is_per_text_once_a_segment_differs():
    encoder = pieces.PieceEncoder()
    texts = ["one two", "three four", "five  six"]
    ids = list(encoder(texts))
    assert encoder.parity(texts, ids) == [True] * 3
    wrong = [ids[0], ids[1][:-1], ids[2]]
    encoder.differing = 1
    assert encoder.parity(texts, wrong) == [True, False, True]


def test_every_whole_text_is_compared():
    """Texts that go wrong between segments, anywhere in a batch, while every segment is right."""
    encoder = pieces.PieceEncoder()
    texts = [f"text {n} of some" for n in range(300)]
    ids = list(encoder(texts))
    wrong = [i[::-1] if n in (1, 255, 299) else i for n, i in enumerate(ids)]
    assert encoder.differing == 0
    assert [n for n, same in enumerate(encoder.parity(texts, wrong)) if not same] == [1, 255, 299]
