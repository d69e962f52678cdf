"""The distinct words of many slices of texts, with a dense code for every occurrence."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from lotbook.llm.text_arrays import LOWER, Spans


def spelled(spans: Spans, chosen: np.ndarray, fold: np.ndarray = LOWER) -> pa.Array:
    """The chosen pieces as strings, after the byte-to-byte map ``fold``."""
    starts, sizes = spans.starts[chosen], (spans.ends - spans.starts)[chosen]
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    at = np.arange(bounds[-1], dtype=np.int64) + np.repeat(starts - bounds[:-1], sizes)
    data = fold[spans.texts.data[at]]
    return pa.Array.from_buffers(pa.large_string(), len(chosen), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


class Vocabulary:
    """Gathers hashed words slice by slice; words of equal 64-bit hash count as equal."""

    def __init__(self):
        self._hashes: list[np.ndarray] = []
        self._codes: list[np.ndarray] = []
        self._strings: list[pa.Array] = []
        self._size = 0

    def add(self, spans: Spans, hashes: np.ndarray) -> np.ndarray:
        """Takes the words of a slice in; returns the places of the words that stand for the slice's distinct ones."""
        fresh, first, code = np.unique(hashes, return_index=True, return_inverse=True)
        self._hashes.append(fresh)
        self._codes.append(code.ravel() + self._size)
        self._strings.append(spelled(spans, first))
        self._size += len(fresh)
        return first

    def finish(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The distinct words, for each the place among all that :meth:`add` returned, and a code per occurrence."""
        if not self._size:
            return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
        _, first, code = np.unique(np.concatenate(self._hashes), return_index=True, return_inverse=True)
        strings = pa.chunked_array(self._strings).combine_chunks().take(pa.array(first))
        return strings, first, code.ravel()[np.concatenate(self._codes)]
