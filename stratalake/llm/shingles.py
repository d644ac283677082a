"""Word shingles as 64-bit hashes, for batches of documents inside a task.

A document's set: its distinct five-word shingles; with fewer words the whole sequence as one; none
without words. Equal shingles have equal hashes everywhere; two different shingles of one pair of
documents agree with a probability of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import xxhash

from stratalake.llm.common import words

WIDTH = 5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_CACHED_WORDS = 200_000


class _WordHashes(dict):
    """Hash of a word; common words are looked up, the table is emptied when it is full."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= _CACHED_WORDS:
            self.clear()
        self[word] = value
        return value


_HASHES = _WordHashes()


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts one after the other, and each text's number of words."""
    per_text, lengths = [], np.zeros(len(texts), dtype=np.int64)
    look_up = _HASHES.__getitem__
    for i, text in enumerate(texts):
        found = words(text)
        lengths[i] = len(found)
        per_text.append(np.fromiter(map(look_up, found), dtype=np.uint64, count=len(found)))
    return np.concatenate(per_text) if per_text else np.zeros(0, np.uint64), lengths


def combined(columns: list[np.ndarray]) -> np.ndarray:
    """One hash per row of word hashes; the order of words and their number count."""
    value = np.full(len(columns[0]), len(columns), dtype=np.uint64)
    for column in columns:
        value = value * _MULTIPLIER + column
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(29)
    return value


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words of one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return combined([hashes[i : i + n] for i in range(width)])


def shingle_sets(texts: list[bytes | None], width: int = WIDTH) -> list[np.ndarray]:
    """The distinct shingles of every text, ascending."""
    hashes, lengths = word_hashes(texts)
    ends = np.cumsum(lengths)
    runs = windows(hashes, width)
    sets = []
    for end, n in zip(ends.tolist(), lengths.tolist(), strict=True):
        if n >= width:
            sets.append(np.unique(runs[end - n : end - width + 1]))
        elif n:
            sets.append(windows(hashes[end - n : end], n))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def shingle_texts(text: bytes | None, width: int = WIDTH) -> set[bytes]:
    """The distinct shingles themselves. Words hold no space, so joining them is unambiguous."""
    found = words(text)
    if len(found) < width:
        return {b" ".join(found)} if found else set()
    return {b" ".join(found[i : i + width]) for i in range(len(found) - width + 1)}
