"""Word shingles of whole Arrow columns of text, hashed with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
#: Bytes of text that a task works on at a time.
SLICE_BYTES = 4 << 20
_BASE = 0x9E3779B97F4A7C15 | 1

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finisher of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column without nulls, and where its texts start and end."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8), bounds


def byte_slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose texts have so many bytes, or that are of one row.

    What a task works on at once is then bounded by its longest text, not by the batch.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(batch):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _pieces(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of about a megabyte, at white space or between texts."""
    at, end = int(bounds[0]), int(bounds[-1])
    while at < end:
        stop = at + PIECE_BYTES
        if stop < end:
            limit = int(bounds[np.searchsorted(bounds, stop)])
            while stop < limit:
                found = SPACES[data[stop : min(stop + 4096, limit)]]
                if found.any():
                    stop += int(found.argmax())
                    break
                stop = min(stop + 4096, limit)
        stop = min(stop, end)
        yield at, stop
        at = stop


@lru_cache(2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    powers = np.full(size, _BASE, np.uint64)
    inverses = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    powers[0] = inverses[0] = 1
    return np.cumprod(powers), np.cumprod(inverses)


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word, A-Z lower-cased, and the number of words of each text.

    Words are what stands between ASCII white space. Equal words have equal hashes
    wherever they stand.
    """
    hashes, owners = [], []
    for start, stop in _pieces(data, bounds):
        part = data[start:stop]
        solid = ~SPACES[part]
        cuts = bounds[np.searchsorted(bounds, start) : np.searchsorted(bounds, stop)] - start
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        begins[cuts] = solid[cuts]
        inner = cuts[cuts > 0] - 1
        ends[inner] = solid[inner]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        powers, inverses = _powers(1 << max(20, int(len(part)).bit_length()))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((LOWER[part].astype(np.uint64) + np.uint64(1)) * powers[: len(part)], out=sums[1:])
        hashes.append(mix((sums[last] - sums[first]) * inverses[first]))
        owners.append(np.searchsorted(bounds, first + start, "right") - 1)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    counts = np.bincount(np.concatenate(owners), minlength=len(bounds) - 1)
    return np.concatenate(hashes), counts


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    hashes, counts = word_hashes(*text_bytes(column))
    ends = np.cumsum(counts)
    factors = [np.uint64(pow(_BASE, 2 * place + 3, 1 << 64)) for place in range(words)]
    rolled = np.zeros(len(hashes), np.uint64)
    for place, factor in enumerate(factors[: len(hashes)]):
        rolled[: len(hashes) - place] += hashes[place:] * factor
    rolled = mix(rolled)
    for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
        if count >= words:
            yield np.unique(rolled[end - count : end - words + 1])
        elif count:
            short = hashes[end - count : end]
            total = sum(int(h) * int(f) for h, f in zip(short, factors, strict=False)) + count
            yield mix(np.array([total % (1 << 64)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
