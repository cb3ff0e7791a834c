"""Whole texts to token ids with the tokenizers library, word by word where that is exact."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from patchloom.llm.shingles import CHUNK_BYTES, StretchHasher, bytes_of, groups

# Words kept with their ids in one task, about 50 bytes each; beyond that the memory starts anew.
CACHE_WORDS = 500_000
# Texts looked at together, a longer one alone: a word that repeats within them is looked up once.
GROUP_BYTES = 1 << 20
# White space before a space or line end, or beyond the plain kinds: such a text is encoded in one piece.
_ODD_SPACE = re.compile(r"\s[\x20\n]|[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_ENDS = '.,;:!?*#$%&()"'


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in own)
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts.

    A byte-level vocabulary splits texts before a space or line end that stands
    alone, so words can be encoded once and remembered, by 64-bit hashes. Words
    of letters only go to the merges directly, many in one call. Everything else
    takes the library's whole way; the ids are the same (there is a test for it).
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.whole.model)
        self.merges.model._resize_cache(0)  # words are remembered here
        self.letters = byte_letters()
        self.space = chr(self.letters[0x20])
        vocabulary = self.whole.get_vocab()
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(self.space)]] = True
        self.hasher = StretchHasher()
        self.space_like = np.zeros(256, bool)
        self.space_like[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
        self._forget()

    def _forget(self) -> None:
        self.keys, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters that follow a space: only their first tokens begin with one, which tells them apart."""
        if not words:
            return []
        space, letters = self.space, self.letters
        mapped = [space + (w if w.isascii() else w.encode().decode("latin-1").translate(letters)) for w in words]
        (found,) = self.merges.encode_batch_fast([mapped], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        cuts = (4 * np.flatnonzero(self.opens[ids])).tolist()
        body = ids.tobytes()
        return [body[a:b] for a, b in zip(cuts, [*cuts[1:], len(body)], strict=True)]

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Ids of words with the space or line end that they follow, or none at a text's start."""
        cores = [core if (core := w.rstrip(_ENDS))[-1:].isalnum() else w for w in words]
        plain = list({c[1:] for c in cores if c[:1] == " " and c[1:].isalpha()})
        known = dict(zip([" " + c for c in plain], self._spaced(plain), strict=True))
        rest = list(set(cores).difference(known))
        known.update(zip(rest, self._ids(rest), strict=True))
        ends = list({w[len(c) :] for w, c in zip(words, cores, strict=True)} - {""})
        tails = dict(zip(ends, self._ids(ends), strict=True))
        tails[""] = b""
        return [known[c] + tails[w[len(c) :]] for w, c in zip(words, cores, strict=True)]

    def _odd(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Which texts are to be encoded in one piece."""
        n = len(bounds) - 1
        odd = np.zeros(n, bool)
        if len(data) < 2:
            return odd
        here, after = data[:-1], data[1:]
        pairs = self.space_like[here] & ((after == 0x20) | (after == 0x0A))
        pairs[bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))] - 1] = False
        rare = (here >= 0x1C) & (here <= 0x1F) | (here == 0xC2) & ((after == 0x85) | (after == 0xA0))
        rare |= (here >= 0xE1) & (here <= 0xE3) & ((after == 0x9A) | (after == 0x80) | (after == 0x81))
        odd[np.searchsorted(bounds, np.flatnonzero(pairs), "right") - 1] = True
        look = np.unique(np.searchsorted(bounds, np.flatnonzero(rare), "right") - 1)
        for i in look[~odd[look]]:
            odd[i] = _ODD_SPACE.search(data[bounds[i] : bounds[i + 1]].tobytes().decode()) is not None
        return odd

    def _words(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, starts and ends of words, each with the space or line end before it."""
        opens = (data == 0x20) | (data == 0x0A)
        opens[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(opens)
        ends = np.concatenate([starts[1:], [len(data)]]) if len(starts) else starts
        hashes, at = np.empty(len(starts), np.uint64), 0
        while at < len(starts):  # a few words at a time, so that the work stays in the processor's cache
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK_BYTES, "right")))
            hashes[at:to] = self.hasher.hashes(data[starts[at] : ends[to - 1]], starts[at:to] - starts[at], ends[at:to] - starts[at])
            at = to
        return hashes, starts, ends

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, one past the last, ids, their offsets per text); null is empty."""
        all_data, offsets = bytes_of(texts)
        for at, to in groups(offsets, GROUP_BYTES):
            data, bounds = all_data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            odd = self._odd(data, bounds)
            hashes, starts, ends = self._words(data, bounds)
            owner = np.searchsorted(bounds, starts, "right") - 1
            if odd.any():
                plain = ~odd[owner]
                hashes, starts, ends, owner = hashes[plain], starts[plain], ends[plain], owner[plain]
            which, words = self._looked_up(data, hashes, starts, ends)
            size = self.sizes[words][which]
            counts = np.bincount(owner, weights=size, minlength=to - at).astype(np.int64)
            whole = {}
            if odd.any():
                picked = np.flatnonzero(odd)
                bodies = self._ids([data[bounds[i] : bounds[i + 1]].tobytes().decode() for i in picked])
                whole = {int(i): np.frombuffer(b, "<u4") for i, b in zip(picked, bodies, strict=True)}
                for i, ids in whole.items():
                    counts[i] = len(ids)
            out = np.concatenate([[0], np.cumsum(counts)])
            ids = np.empty(out[-1], np.uint32)
            # Where each word's ids go: after those of the words before it, and of whole texts.
            first = np.cumsum(size) - size
            if whole:
                skipped = np.concatenate([[0], np.cumsum(np.where(odd, counts, 0))])[:-1]
                first = first + skipped[owner]
            step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            source = np.repeat(self.starts[words][which], size) + step
            if whole:
                ids[np.repeat(first, size) + step] = self.pool[source]
                for i, own in whole.items():
                    ids[out[i] : out[i] + len(own)] = own
            else:
                ids[:] = self.pool[source]
            yield at, to, ids, out

    def _looked_up(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word its number among the distinct ones, and the place in the memory of each of those; new words are learnt."""
        order = np.argsort(hashes)
        ranked = hashes[order]
        new = np.ones(len(ranked), bool)
        np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
        which = np.empty(len(hashes), np.int64)
        which[order] = np.cumsum(new) - 1
        distinct, sample = ranked[new], order[new]
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        missing = np.flatnonzero(~known)
        if len(missing):
            body = data.tobytes()
            cuts = zip(starts[sample[missing]].tolist(), ends[sample[missing]].tolist(), strict=True)
            learnt = self._encoded([body[a:b].decode() for a, b in cuts])
            if len(self.keys) + len(missing) > CACHE_WORDS:  # keep what this group asks for
                used = place[known]
                sizes = self.sizes[used]
                step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                self.pool = self.pool[np.repeat(self.starts[used], sizes) + step]
                self.keys, self.starts, self.sizes = self.keys[used], np.cumsum(sizes) - sizes, sizes
            sizes = np.array([len(x) // 4 for x in learnt], np.int64)
            keys = np.concatenate([self.keys, distinct[missing]])
            merged = np.argsort(keys, kind="stable")
            self.keys = keys[merged]
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])[merged]
            self.sizes = np.concatenate([self.sizes, sizes])[merged]
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(learnt), "<u4")])
            place = np.searchsorted(self.keys, distinct)
        return which, place
