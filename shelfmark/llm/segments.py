"""Fast exact tokenizing: cut texts into segments that no merge crosses, encode each kind once.

Code points of many texts are cut at once with numpy; distinct segments, found by a 64-bit
hash, are encoded by the tokenizer and kept; ids of whole texts are gathered from those.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np

OTHER, LETTER, NUMBER, SPACE = range(4)

# The code points of Unicode's White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# Texts are worked on in pieces of about so many code points.
PIECE_CHARS = 1 << 19
#: Bytes that the store of known segments takes before it is emptied.
KEPT_BYTES = 48 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(1)
def character_classes() -> np.ndarray:
    classes = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind in "LN":
            classes[point] = LETTER if kind == "L" else NUMBER
    classes[list(WHITE_SPACE)] = SPACE
    return classes


def word_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where byte-level BPE's pre-tokens start, as a mask over the code points.

    Runs of letters, of digits and of other signs, each with a space before it; of more
    white space, the last sign before such a run stands apart; English contractions.
    """
    n = len(points)
    kinds = character_classes()[points]
    begins = np.zeros(n, bool)
    begins[text_starts[text_starts < n]] = True
    starts = begins.copy()
    starts[1:] |= kinds[1:] != kinds[:-1]
    follows = np.zeros(n, bool)  # the next sign is in the same text and is no white space
    follows[:-1] = ~begins[1:] & (kinds[1:] != SPACE)
    last = np.flatnonzero((kinds == SPACE) & follows)
    starts[last] = True
    starts[last[points[last] == 0x20] + 1] = False
    quotes = np.flatnonzero((points == 0x27) & starts & follows)
    if len(quotes):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        ends = np.concatenate([begins, [True, True]])
        first, second = padded[quotes + 1], np.where(ends[quotes + 2], 0, padded[quotes + 2])
        one = np.isin(first, [ord(c) for c in "stmd"])
        two = np.zeros(len(quotes), bool)
        for pair in ("re", "ve", "ll"):
            two |= (first == ord(pair[0])) & (second == ord(pair[1]))
        for found, size in ((quotes[one], 1), (quotes[two & ~one], 2)):
            starts[found + 1] = False
            rest = found + 1 + size
            rest = rest[rest < n]
            starts[rest[kinds[rest] == LETTER]] = True
    return starts


def marked_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where runs of the space marker start: no piece has one after another sign."""
    marker = points == 0x2581
    starts = np.zeros(len(points), bool)
    starts[text_starts[text_starts < len(points)]] = True
    starts[1:] |= marker[1:] & ~marker[:-1]
    return starts


@lru_cache(2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    powers = np.full(size, _BASE, np.uint64)
    inverses = np.full(size, inverse, np.uint64)
    powers[0] = inverses[0] = 1
    return np.cumprod(powers), np.cumprod(inverses)


def segment_hashes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each segment, the same wherever the segment stands."""
    size = 1 << max(16, int(len(points)).bit_length())
    powers, inverses = _powers(size)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers[: len(points)], out=sums[1:])
    ends = np.append(starts[1:], len(points))
    hashes = (sums[ends] - sums[starts]) * inverses[starts]
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(29))


class HashPlaces:
    """Numbers of known hashes: an open table looked up and filled for whole arrays at once.

    It doubles whenever it would get more than half full.
    """

    def __init__(self, room: int):
        self.known = 0
        self._open(1 << (2 * room - 1).bit_length())

    def _open(self, size: int) -> None:
        self.mask = np.uint64(size - 1)
        self.keys = np.zeros(size, np.uint64)
        self.places = np.full(size, -1, np.int32)

    @property
    def nbytes(self) -> int:
        return self.keys.nbytes + self.places.nbytes

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where unknown."""
        slots = (hashes & self.mask).astype(np.int64)
        found = np.where(self.keys[slots] == hashes, self.places[slots], -1)
        open_ = np.flatnonzero((found < 0) & (self.places[slots] >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & int(self.mask)
            at = slots[open_]
            hit = self.keys[at] == hashes[open_]
            found[open_[hit]] = self.places[at[hit]]
            open_ = open_[~hit & (self.places[at] >= 0)]
        return found

    def add(self, hashes: np.ndarray, first: int) -> None:
        """Number distinct unknown hashes from ``first`` on."""
        self.known += len(hashes)
        if 2 * self.known > len(self.keys):
            filled = self.places >= 0
            keys, numbers = self.keys[filled], self.places[filled]
            self._open(1 << (2 * self.known - 1).bit_length())
            self._fill(keys, numbers)
        self._fill(hashes, np.arange(first, first + len(hashes), dtype=np.int32))

    def _fill(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        slots = (hashes & self.mask).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.places[slots[left]] < 0]
            _, winners = np.unique(slots[free], return_index=True)
            placed = free[winners]
            self.keys[slots[placed]] = hashes[placed]
            self.places[slots[placed]] = numbers[placed]
            done = np.zeros(len(hashes), bool)
            done[placed] = True
            left = left[~done[left]]
            taken = self.places[slots[left]] >= 0
            slots[left[taken]] = (slots[left[taken]] + 1) & int(self.mask)


class SegmentEncoder:
    """Ids of texts by way of their distinct segments.

    ``encode`` gives the ids of each of a list of segments, called once per distinct
    segment as long as it is kept; the store is emptied when what a piece adds could take it
    past its bytes. A single piece's segments are always kept until the piece is done.
    """

    def __init__(
        self,
        find_starts: Callable[[np.ndarray, np.ndarray], np.ndarray],
        encode: Callable[[list[str]], Sequence[Sequence[int]]],
        kept_bytes: int = KEPT_BYTES,
    ):
        self.find_starts, self.encode, self.kept_bytes = find_starts, encode, kept_bytes
        self.forget()

    def forget(self) -> None:
        self.known = 0
        self.places = HashPlaces(1 << 12)
        self.ids = np.zeros(1 << 12, np.uint32)
        self.offsets = np.zeros(1 << 12, np.int64)
        self.sizes = np.zeros(1 << 12, np.int64)
        self.used = 0

    @property
    def nbytes(self) -> int:
        return sum(kept.nbytes for kept in (self.places, self.ids, self.offsets, self.sizes))

    def _learn(self, hashes: np.ndarray, segments: list[str]) -> None:
        known, new = self.known, self.known + len(segments)
        encoded = self.encode(segments)
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter(chain.from_iterable(encoded), np.uint32, int(sizes.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while new > len(self.sizes):
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
            self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.sizes[known:new] = sizes
        self.offsets[known:new] = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        self.places.add(hashes, known)
        self.known = new

    def _piece(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts, and how many each has."""
        joined = "".join(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        if not joined:
            return np.zeros(0, np.uint32), lengths
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        text_starts = np.cumsum(lengths) - lengths
        starts = np.flatnonzero(self.find_starts(points, text_starts))
        hashes = segment_hashes(points, starts)
        places = self.places.find(hashes)
        if (places < 0).any():
            unknown = np.flatnonzero(places < 0)
            distinct, first = np.unique(hashes[unknown], return_index=True)
            if self.known and self.nbytes > self.kept_bytes:
                self.forget()
                unknown = np.arange(len(hashes))
                distinct, first = np.unique(hashes, return_index=True)
            at = unknown[first]
            ends = np.append(starts[1:], len(points))
            spans = zip(starts[at].tolist(), ends[at].tolist(), strict=True)
            self._learn(distinct, [joined[a:b] for a, b in spans])
            places[unknown] = self.places.find(hashes[unknown])
        sizes = self.sizes[places]
        ends = np.cumsum(sizes)
        ids = self.ids[
            np.repeat(self.offsets[places] - (ends - sizes), sizes) + np.arange(int(ends[-1]))
        ]
        before = np.append(0, ends)  # ids before each segment
        bounds = np.searchsorted(starts, np.append(text_starts, len(points)))
        return ids, np.diff(before[bounds])

    def __call__(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        piece: list[str] = []
        chars = 0
        for text in texts:
            if len(text) > PIECE_CHARS:
                yield from self._split(piece)
                piece, chars = [], 0
                yield np.concatenate([ids for part in cut_long(text) for ids in self._split([part])])
                continue
            if chars + len(text) > PIECE_CHARS:
                yield from self._split(piece)
                piece, chars = [], 0
            piece.append(text)
            chars += len(text)
        yield from self._split(piece)

    def _split(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        ids, counts = self._piece(texts)
        return np.split(ids, np.cumsum(counts)[:-1])


def cut_long(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Parts of a long text, cut where a space or its marker follows another sign.

    Both ways of cutting into segments start one there whatever follows.
    """
    start = 0
    while len(text) - start > size:
        at = start + size
        while at < len(text) and not (
            text[at] in " ▁" and not text[at - 1].isspace() and text[at - 1] != "▁"
        ):
            at += 1
        yield text[start:at]
        start = at
    if start < len(text):
        yield text[start:]
