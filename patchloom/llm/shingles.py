"""Word and shingle hashes of Arrow text batches, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SEED = 20240607
# Bytes of text that are looked at together; a longer text is cut where words end.
CHUNK_BYTES = 1 << 17

_U = np.uint64


def _constants() -> tuple[np.ndarray, np.ndarray, int]:
    random = np.random.default_rng(_SEED)
    letters = random.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
    spaces = np.zeros(256, bool)
    spaces[[0x20, *range(0x09, 0x0E)]] = True
    return letters, spaces, int(random.integers(1, 1 << 62)) * 2 + 1


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    up = np.full(n, base, np.uint64)
    down = np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offset of each text in them; null is empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    return np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8), offsets


def groups(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first text, one past the last) of runs of texts of at most ``most`` bytes, a longer text alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to


def grouped_bytes(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, one past the last, their bytes, offsets in them); groups of at most CHUNK_BYTES, a longer text alone."""
    data, offsets = bytes_of(texts)
    for at, to in groups(offsets, CHUNK_BYTES):
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]


class StretchHasher:
    """64-bit hashes of stretches of bytes."""

    def __init__(self, letters: np.ndarray | None = None) -> None:
        plain, _, self.base = _constants()
        self.letters = plain if letters is None else letters
        self.up, self.down = _powers(1 << 16, self.base)

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.up):
            self.up, self.down = _powers(max(len(data) + 1, 2 * len(self.up)), self.base)
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.letters[data] * self.up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts])


class WordHasher:
    """64-bit hashes of words: A-Z as a-z, words being runs without space and tab to carriage return."""

    def __init__(self) -> None:
        letters, self.spaces, _ = _constants()
        letters[65:91] = letters[97:123]  # A-Z as a-z
        self.stretches = StretchHasher(letters)

    def _chunk(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Hashes and start bytes of the words of one stretch; ``cuts`` are bytes at which texts begin."""
        solid = ~self.spaces[data]
        first = np.empty_like(solid)
        first[0] = True
        np.logical_not(solid[:-1], out=first[1:])
        first[cuts] = True
        last = np.empty_like(solid)
        last[-1] = True
        last[:-1] = ~solid[1:]
        last[cuts[cuts > 0] - 1] = True
        starts, ends = np.flatnonzero(solid & first), np.flatnonzero(solid & last) + 1
        return self.stretches.hashes(data, starts, ends), starts, ends

    def texts(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first text, one past the last, word hashes, word offsets per text, start and end bytes of words).

        Texts come in groups of at most CHUNK_BYTES, a longer text alone; null is empty.
        Bytes count from the start of the group's first text.
        """
        data, offsets = bytes_of(texts)
        for at, to in groups(offsets, CHUNK_BYTES):
            yield at, to, *self._group(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])

    def _group(self, data: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts, at = [], 0
        while at < len(data):
            to = min(len(data), at + CHUNK_BYTES)
            if to < len(data):  # only within one long text: go back to a space, or on to the next one
                space = np.flatnonzero(self.spaces[data[at:to]])
                if len(space) and space[-1] > 0:
                    to = at + int(space[-1])
                else:
                    while to < len(data) and not self.spaces[data[to]]:
                        to += 1
            begin = own[:-1]
            cuts = np.unique(begin[(begin >= at) & (begin < to)] - at)
            h, s, e = self._chunk(data[at:to], cuts)
            parts.append((h, s + at, e + at))
            at = to
        if not parts:
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), np.zeros(len(own), np.int64), np.zeros((2, 0), np.int64) + none
        hashes, starts, ends = (np.concatenate(x) for x in zip(*parts, strict=True))
        return hashes, np.searchsorted(starts, own), np.stack([starts, ends])


def shingles(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text, in order, and their offsets.

    A text of fewer than k words has its whole sequence as its one shingle; one without words has none.
    """
    counts = np.diff(offsets)
    own = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(own)])
    factors = mix(np.arange(1, k + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)
    # Of a text's places, those at which a shingle starts.
    place = np.repeat(offsets[:-1] - bounds[:-1], own) + np.arange(bounds[-1])
    length = np.repeat(np.minimum(counts, k), own)
    total = length.astype(np.uint64)
    if len(place):
        padded = np.concatenate([words, np.zeros(k, np.uint64)])
        short = bool((length < k).any())
        for j in range(k):
            term = padded[place + j] * factors[j]
            total += np.where(length > j, term, _U(0)) if short else term
    return mix(total), bounds
