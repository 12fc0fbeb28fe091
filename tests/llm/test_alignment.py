import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings as hypothesis_settings, strategies as st
from tokenizers import Tokenizer

from conftest import ROWS
from shelfmark.llm import alignment, packing, pieces, queries

NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
NONE = (0, 0, 0, 0, 0, 0, "")
ODD = [
    "it's we're  don't", "a  b\n\n c \t\n", " ", "\n", "x <|endoftext|> y", "日本語 テキスト ½ 12ab",
    "<s> </s> <unk>", "a ▁ marker", "▁", "é ñ 😀😀", "<0x41> A", "x1" * 3000, "tab\tnew 123 4567", "▁a",
]


@pytest.fixture(scope="module")
def tokenizers():
    first = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


def brute_groups(text, tokenizers):
    """The groups of a text, pairs of lists of ids; None where a side does not give it back."""
    first, second = tokenizers
    signs = {packing.byte_signs().get(byte, chr(byte)): byte for byte in range(256)}
    a = [(i, bytes(signs[s] for s in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    if any(b"".join(t for _, t in side) != (" " + text).encode() for side in (a, b)):
        return None
    groups, left = [], ([], [])
    at = [0, 0]
    place = [0, 0]
    sides = (a, b)
    while any(place[k] < len(sides[k]) for k in (0, 1)):
        k = 0 if at[0] <= at[1] and place[0] < len(a) else 1
        number, data = sides[k][place[k]]
        left[k].append(number)
        at[k] += len(data)
        place[k] += 1
        if at[0] == at[1]:
            groups.append(left)
            left = ([], [])
    return groups


def wanted(texts, tokenizers):
    found = [brute_groups(text, tokenizers) if text else None for text in texts]
    links = [Counter((a, b) for x, y in groups for a in x for b in y) if groups else Counter() for groups in found]
    counts = Counter(pair for of in links for pair in of)
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    rows = []
    for groups, of in zip(found, links, strict=True):
        if not groups:
            rows.append(NONE)
            continue
        listed = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(of.values()),
            sum(n for pair, n in of.items() if counts[pair] == most[pair[0]]),
            sum(n * counts[pair] for pair, n in of.items()), hashlib.sha256(listed.encode()).hexdigest(),
        ))
    return rows


def got(df):
    assert df.columns == ["doc_id", *NAMES]
    return Counter((r.doc_id, *(r[name] for name in NAMES)) for r in df.collect())


def test_documents(spark, sf_small, texts, tokenizers):
    found = got(queries.QUERIES["op12_alignment"](spark, sf_small))
    assert found == Counter((n, *row) for n, row in zip(texts, wanted(texts.values(), tokenizers), strict=True))


def test_small_slices_and_copies(spark, tokenizers):
    """Slices of one text each, and copies that count as documents each."""
    texts = [*ODD, "", None, *ODD[:4], *[ODD[5]] * 20]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = got(alignment.align_documents(docs, slice_bytes=1))
    assert found == Counter((n, *row) for n, row in enumerate(wanted(texts, tokenizers)))
    assert sum(row[1:] == NONE for row in found) > 2  # markers in a text, null and empty


def test_edges(edge_docs, empty_docs, tokenizers):
    found = got(alignment.align_documents(edge_docs))
    want = wanted([text for _, text in ROWS], tokenizers)
    assert found == Counter((n, *row) for (n, _), row in zip(ROWS, want, strict=True))
    assert got(alignment.align_documents(empty_docs)) == Counter()


SIGNS = st.text(st.sampled_from("ab é'sretvlmd  \n\t12.,!日▁<😀"), min_size=1, max_size=30)


@hypothesis_settings(max_examples=200, deadline=None)
@given(texts=st.lists(SIGNS, min_size=1, max_size=5))
def test_any_texts(tokenizers, texts):
    found = alignment.aligned(texts, alignment.kept_sides(None, None))
    for place, text in enumerate(texts):
        groups = brute_groups(text, tokenizers)
        pairs = Counter((a, b) for x, y in groups or () for a in x for b in y)
        span = slice(found.bounds[place], found.bounds[place + 1])
        keys = found.pairs[found.entries[span]]
        own = zip((keys >> np.uint64(32)).tolist(), (keys & np.uint64(0xFFFFFFFF)).tolist(), strict=True)
        assert dict(zip(own, found.times[span].tolist(), strict=True)) == pairs
        listed = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups or ())
        assert found.groups[place] == listed
        assert (found.n_groups[place], found.n_links[place]) == (len(groups or ()), sum(pairs.values()))
