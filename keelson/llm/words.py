"""Words of texts as arrays of 64-bit hashes, for the operators that run on Arrow batches.

A batch is cut into slices of about ``SLICE_WORDS`` words (whole documents, at least one),
so the memory in use does not grow with the batch; one document is the unit that has to fit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SLICE_WORDS = 400_000
_VOCABULARY = 300_000

ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F),
       np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))


class WordIds(dict):
    """64-bit hash of each word, remembered; forgets all when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _VOCABULARY:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


@dataclass
class Slice:
    """Some consecutive rows of a batch: the word hashes of all, and where each row starts."""
    first: int           # row number in the batch
    starts: np.ndarray   # starts[k] : starts[k + 1] are the words of row first + k
    words: np.ndarray    # uint64

    @property
    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def room(self, length: int) -> np.ndarray:
        """Whether ``length`` words of the same row start at each word."""
        ends = np.repeat(self.starts[1:], np.diff(self.starts))
        return np.arange(len(self.words)) + length <= ends


def slices(texts: pa.Array, split: Callable[[bytes], list[bytes]],
           ids: WordIds) -> Iterator[Slice]:
    """NULL texts are rows without words."""
    first, sizes, parts, held = 0, [], [], 0
    column = texts.cast(pa.large_binary())
    for row, value in enumerate(column):
        text = value.as_py()
        words = split(text) if text else []
        parts.append(np.fromiter(map(ids.__getitem__, words), np.uint64, len(words)))
        sizes.append(len(words))
        held += len(words)
        if held >= SLICE_WORDS:
            yield Slice(first, np.concatenate(([0], np.cumsum(sizes))), np.concatenate(parts))
            first, sizes, parts, held = row + 1, [], [], 0
    if sizes:
        yield Slice(first, np.concatenate(([0], np.cumsum(sizes))), np.concatenate(parts))


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * ODD[0]
    x = x ^ (x >> np.uint64(29))
    x = x * ODD[3]
    return x ^ (x >> np.uint64(32))


def rolling(words: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """At each word: polynomial hash of ``length`` words from there (the last are cut off).

    Doubles the length as binary places ask, so it costs log(length) array operations.
    """
    total, have, block, size = None, 0, words, 1
    step = base
    steps = {1: base}
    rest = length
    while rest:
        if rest & 1:
            if total is None:
                total = block
            else:
                n = len(block) - have if len(block) > have else 0
                n = min(n, len(total))
                total = total[:n] * steps[size] + block[have:have + n]
            have += size
        rest >>= 1
        if rest:
            block = block[:max(len(block) - size, 0)] * step + block[size:]
            size *= 2
            with np.errstate(over="ignore"):
                step = step * step
            steps[size] = step
    return total


def ascii_lower_words(text: bytes) -> list[bytes]:
    return text.lower().split()
