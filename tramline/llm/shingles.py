"""Word shingles of texts as 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

#: Bytes of text that are hashed together; a batch takes some 80 times as much
#: memory. A longer text is one batch.
BATCH_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    out[1:] = base
    return np.multiply.accumulate(out)


_POWERS: list[np.ndarray] = []


def release() -> None:
    """Give the tables' memory back."""
    _POWERS.clear()


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of them."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POWERS[:] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _POWERS[0], _POWERS[1]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word; A-Z count as a-z."""
    b = np.frombuffer(raw.translate(_LOWER), dtype=np.uint8)
    blank = _BLANK[b]
    edge = np.diff(blank.view(np.int8), prepend=1, append=1)
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return start, np.zeros(0, dtype=np.uint64)
    up, down = _tables(len(b) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum((b + np.uint64(1)) * up[:len(b)])])
    return start, mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_sets(texts: list[str | None], words: int = 4) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text. A text of fewer words has
    its whole sequence as its one shingle; one without words has none."""
    weights = _powers(np.uint64(0xD1342543DE82EF95), words + 1)[1:]
    start = 0
    while start < len(texts):
        parts, size, stop = [], 0, start
        while stop < len(texts) and (stop == start or size < BATCH_BYTES):
            parts.append((texts[stop] or "").encode())
            size += len(parts[-1]) + 1
            stop += 1
        at, h = word_hashes(b"\n".join(parts))
        ends = np.cumsum([len(p) + 1 for p in parts])
        first = np.concatenate([[0], np.searchsorted(at, ends)])
        rolled = np.zeros(max(0, len(h) - words + 1), dtype=np.uint64)
        for k in range(words):
            rolled += h[k:k + len(rolled)] * weights[k]
        rolled = mix(rolled)
        for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
            if z - a >= words:
                yield np.unique(rolled[a:z - words + 1])
            elif z > a:
                yield mix((h[a:z] * weights[:z - a]).sum(keepdims=True) + np.uint64(z - a))
            else:
                yield h[:0]
        start = stop


def set_digest(hashes: np.ndarray) -> int:
    """A signed 64-bit digest of a set of hashes, in any order."""
    words = mix(hashes ^ np.uint64(0xA0761D6478BD642F))
    both = np.array([np.bitwise_xor.reduce(words), words.sum(dtype=np.uint64)])
    return int(mix(both * np.array([_BASE, 1], dtype=np.uint64)).sum(dtype=np.uint64)
               .view(np.int64))
