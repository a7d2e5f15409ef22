"""Cuts a text where byte-level BPE pre-tokenisation must cut too, so that parts can be encoded once and cached.

The public byte-level pattern lets one space join the word after it and gives a lone line feed between two
non-blanks a match of its own. A space or a line feed between two non-blank characters therefore always begins a
match, whatever stands around it; and where punctuation alone follows a letter, the letter ends one. The matches of the
whole text are those of the parts between such places. Python counts a few control characters as blank that the
pattern doesn't; this only leaves some cuts out.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space between two non-blanks.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Entries in a worker's cache before it starts afresh, about 280 MB.
CACHE_ENTRIES = 1_300_000
#: Parts longer than this are not kept, so that the cache stays within its bound.
CACHE_CHARS = 48

PUNCTUATION = string.punctuation

TEXTS_AT_ONCE = 16

Encode = Callable[[list[str]], list[bytes]]


class Kept(dict):
    """Key -> ids as bytes; unknown keys are encoded one at a time."""

    def __init__(self, encode: Encode, most: int = CACHE_ENTRIES):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, key: str) -> bytes:
        (ids,) = self.encode([key])
        if len(key) <= CACHE_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[key] = ids
        return ids

    def learn(self, keys: set[str]) -> None:
        """Encodes the new ones of the keys in one call."""
        new = [k for k in keys if k not in self and len(k) <= CACHE_CHARS]
        if len(self) + len(new) > self.most:
            self.clear()
            new = [k for k in keys if len(k) <= CACHE_CHARS]
        self.update(zip(new, self.encode(new), strict=True))


def split_at(lengths: np.ndarray, parts: list[int]) -> np.ndarray:
    """Where the parts end in a sequence of pieces, given the pieces' and the parts' lengths in the same unit."""
    return np.searchsorted(np.cumsum(lengths), np.cumsum(parts), "left") + 1


def irregular(part: str) -> bool:
    """Whether a part between spaces (or from a line feed on) is not enclosed by non-blanks."""
    return not part or part[-1].isspace() or part[0].isspace() and (part[0] != "\n" or part[1:2].isspace())


def with_blank(part: str) -> str:
    return part if part[0] == "\n" else f" {part}"


class TextEncoder:
    """Whole texts -> ids as little-endian unsigned 32-bit integers.

    Texts are cut and their parts numbered in Arrow; only distinct parts become Python strings, and ids are put together by
    numpy. ``encode`` gets parts that may be joined without change of their matches: each but a sole one
    begins with a space or line feed before a non-blank and ends in a non-blank.
    """

    def __init__(self, encode: Encode, most: int = CACHE_ENTRIES):
        self.parts = Kept(lambda keys: encode([with_blank(k) for k in keys]), most)
        self.odd = Kept(lambda keys: [x for k in keys for x in encode([k])], most // 10)
        self.encode = encode

    def __call__(self, texts: pa.Array | list[str]) -> list[bytes]:
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        n = len(texts)
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        starts = cut.offsets.to_numpy()[: n + 1] - (cut.offsets[0].as_py() if n else 0)
        numbered = cut.flatten().dictionary_encode()
        at, distinct = numbered.indices.to_numpy().astype(np.int64), numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        first = [distinct[k] for k in at[starts[:-1]].tolist()]
        # the first part of a text has no blank before it: it gets a number of its own
        at[starts[:-1]] = len(distinct) + np.arange(n)
        made = list(map(self.parts.get, distinct))
        new = [k for k, ids in enumerate(made) if ids is None]
        odd = np.zeros(len(distinct) + n, bool)
        odd[[k for k in new if irregular(distinct[k])]] = True
        self._learn([distinct[k] for k in new if not odd[k]])
        for k in new:
            made[k] = b"" if odd[k] else self.parts[distinct[k]]
        made += [self.odd[f] for f in first]
        again = np.logical_or.reduceat(odd[at], starts[:-1]).tolist() if n else []
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        pool, begin = np.frombuffer(b"".join(made), "<u4"), np.cumsum(sizes) - sizes
        out, bounds = [], starts.tolist()
        for a in range(0, n, TEXTS_AT_ONCE):  # small steps keep numpy's temporaries in the processor's cache
            b = min(n, a + TEXTS_AT_ONCE)
            own = at[bounds[a] : bounds[b]]
            count = sizes[own]
            ends = np.cumsum(count)
            ids = pool[np.repeat(begin[own] - (ends - count), count) + np.arange(ends[-1])].tobytes()
            edge = [0, *(4 * ends[starts[a + 1 : b + 1] - bounds[a] - 1]).tolist()]
            out += [self._odd(texts[i].as_py()) if again[i] or first[i][-1:].isspace() else ids[edge[i - a] : edge[i - a + 1]] for i in range(a, b)]
        return out

    def _learn(self, new: list[str]) -> None:
        """Adds the new parts. A word that ends in punctuation is put together from the word and the punctuation."""
        plain, ended = [], []
        for p in new:
            core = p.rstrip(PUNCTUATION)
            (ended if len(core) < len(p) <= CACHE_CHARS and core and core[-1].isalpha() else plain).append((p, core))
        self.parts.learn({p for p, _ in plain}.union(core for _, core in ended))
        get, stop = self.parts.__getitem__, self.odd.__getitem__
        self.parts.update([(p, get(core) + stop(p[len(core) :])) for p, core in ended])

    def _odd(self, text: str) -> bytes:
        first, *rest = CUT.split(text)
        return self.odd[first] + b"".join(self.odd[f" {p}"] for p in rest)


def slices(texts: pa.Array, size: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive slices of about so many bytes: (from, to)."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + size, "right")))
        yield start, end
        start = end


def chunks(texts: list[str], chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive slices of about so many characters: (from, to)."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
