"""Word and shingle hashes of texts, for tasks that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from xxhash import xxh64_intdigest

#: Distinct words whose hash a task remembers at a time.
REMEMBERED = 500_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_S31, _S27 = np.uint64(31), np.uint64(27)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> _S31)) * _B
    return x ^ (x >> _S27)


class WordHashes(dict):
    """word -> 64-bit hash; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxh64_intdigest(word)
        return value


def lowered_words(text: bytes) -> list[bytes]:
    """Words between spaces and control characters 9 to 13, A-Z in lower case: what bytes do by themselves."""
    return text.lower().split()


def shingle_set(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of runs of ``size`` words; of fewer words, the whole sequence is one."""
    words = lowered_words(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for k in range(width):
        out = mix(out * _A + h[k : len(h) - width + 1 + k])
    return np.unique(out)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A string column as UTF-8; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def batches(frames: Iterator[pa.RecordBatch], schema: pa.Schema, of) -> Iterator[pa.RecordBatch]:
    """Applies ``of`` (batch -> columns) to each batch."""
    for batch in frames:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(of(batch), schema.types)], schema=schema)
