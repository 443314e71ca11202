"""Words and word shingles of whole texts as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from xxhash import xxh3_64_intdigest, xxh3_128_digest

WIDTH = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)


def words(text: str | None) -> list[bytes]:
    """UTF-8 words between ASCII white space, A-Z lower-cased; bytes do just that."""
    return text.encode().lower().split() if text else []


def word_hashes(text: str | None) -> np.ndarray:
    found = words(text)
    return np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Different shingles in ascending order of hash; a shorter text is one shingle."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    mixed = np.zeros(len(hashes) - width + 1, np.uint64)
    for i in range(width):
        mixed = (mixed ^ hashes[i : i + len(mixed)]) * _FACTOR
        mixed ^= mixed >> _SHIFT
    return np.unique(mixed)


def set_digest(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a set, equal for equal sets."""
    return int.from_bytes(xxh3_128_digest(shingles.tobytes())[:8], "little", signed=True)


def by_bucket(buckets: np.ndarray, *arrays: np.ndarray) -> Iterable[tuple[int, list[np.ndarray]]]:
    """The rows of ``arrays`` that belong to each bucket."""
    order = np.argsort(buckets, kind="stable")
    dealt = buckets[order]
    starts = np.flatnonzero(np.r_[True, dealt[1:] != dealt[:-1]]) if len(dealt) else []
    stops = [*starts[1:], len(dealt)]
    for a, b in zip(starts, stops, strict=True):
        yield int(dealt[a]), [x[order[a:b]] for x in arrays]
