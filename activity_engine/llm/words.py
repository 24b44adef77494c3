"""Hashes of words and shingles, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from activity_engine.llm.common import mix64

# Bytes that are hashed together; longer texts are cut at white space.
CHUNK_BYTES = 1 << 18

_PRIME = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


class WordHasher:
    """64-bit hashes of the words `[^\\x20\\x09-\\x0D]+` of texts whose A-Z are lowered.

    A word's hash is a polynomial of its bytes, taken from one running sum over all texts of a chunk.
    """

    def __init__(self) -> None:
        self._up = _powers(_PRIME, CHUNK_BYTES + 2)
        self._down = _powers(pow(_PRIME, -1, 1 << 64), CHUNK_BYTES + 2)

    def _chunk(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of each word of at most CHUNK_BYTES bytes (a longer word is hashed in one go)."""
        raw = np.frombuffer(data, dtype=np.uint8)
        n = len(raw)
        up, down = (self._up, self._down) if n < len(self._up) else (_powers(_PRIME, n + 1), _powers(pow(_PRIME, -1, 1 << 64), n + 1))
        gap = _SPACE[raw]
        edge = np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8))
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        return mix64((sums[last] - sums[first]) * down[first]), first

    def texts(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The word hashes of each text, in order; null has none."""
        yield from self.parts([(t or "").encode("utf-8", "replace").lower() for t in texts])

    def parts(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The hashes of what stands between white space in each text, in order."""
        group: list[bytes] = []
        size = 0
        for data in texts:
            if group and size + len(data) + 1 > CHUNK_BYTES:
                yield from self._group(group)
                group, size = [], 0
            if len(data) >= CHUNK_BYTES:
                yield from self._group(group)
                group, size = [], 0
                yield self._long(data)
            else:
                group.append(data)
                size += len(data) + 1
        yield from self._group(group)

    def _group(self, group: list[bytes]) -> Iterator[np.ndarray]:
        if not group:
            return
        hashes, first = self._chunk(b" ".join(group))
        ends = np.cumsum([len(d) + 1 for d in group])
        yield from np.split(hashes, np.searchsorted(first, ends[:-1]))

    def _long(self, data: bytes) -> np.ndarray:
        out, at = [], 0
        while at < len(data):
            stop = min(len(data), at + CHUNK_BYTES)
            while stop < len(data) and not _SPACE[data[stop]]:
                stop += 1
            out.append(self._chunk(data[at:stop])[0])
            at = stop
        return np.concatenate(out)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of n words; of fewer words the whole sequence is one."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    size = min(n, len(words))
    h = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        h = mix64(h * np.uint64(_PRIME) + words[k : len(words) - size + 1 + k])
    return np.unique(h)
