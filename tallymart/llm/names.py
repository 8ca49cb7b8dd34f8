"""Exact names of words and of runs of words, for many texts at once.

Equal words of one text get equal numbers (by their bytes, not by a hash), and so do equal
runs of words; numbers of different texts differ.  A run that occurs once in its text has
the name -1, so longer runs are looked for only where shorter ones repeat.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallymart.llm.words import Block


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """The byte runs from starts to ends, in order and apart from each other, as an array."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] = 1
    edge[ends] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers)


def apart(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """As ``joined``, also for runs that touch each other or are empty."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers)


def codes(values: pa.Array) -> np.ndarray:
    """Equal values get equal numbers, dense from 0."""
    return pc.dictionary_encode(values).indices.to_numpy(zero_copy_only=False).astype(np.int64)


def numbered(keys: np.ndarray) -> np.ndarray:
    """Dense numbers of equal keys; -1 where a key occurs once."""
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    return np.where(count[inverse] > 1, inverse, -1)


@dataclass
class Words:
    """Words of some texts: their bytes, the text of each, and its name."""

    values: pa.LargeBinaryArray
    text: np.ndarray
    bounds: np.ndarray  # words of text i: bounds[i]:bounds[i + 1]
    names: np.ndarray

    @classmethod
    def of(cls, block: Block) -> Words:
        return cls.taken(joined(block.data, block.starts, block.ends), block.bounds)

    @classmethod
    def taken(cls, values: pa.Array, bounds: np.ndarray) -> Words:
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        word = codes(values)
        return cls(values, text, bounds, numbered(text * (word.max(initial=0) + 1) + word))

    def longer(self, names: np.ndarray, shift: int) -> np.ndarray:
        """Names of runs that join a run with the one ``shift`` words on, at their first words."""
        out = np.full(len(names), -1, np.int64)
        left, right = names[: max(0, len(names) - shift)], names[shift:]
        here = (left >= 0) & (right >= 0) & (self.text[: len(left)] == self.text[shift:])
        at = np.flatnonzero(here)
        if len(at):
            out[at] = numbered(left[at] * (names.max() + 1) + right[at])
        return out

    def repeated_in_windows(self, k: int) -> np.ndarray:
        """Which words lie in a run of k words that their text holds twice or more."""
        names, size = self.names, 1
        while size * 2 <= k:
            names, size = self.longer(names, size), size * 2
        if size < k:
            names = self.longer(names, k - size)
        edge = np.zeros(len(names) + 1, np.int64)
        at = np.flatnonzero(names >= 0)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + k, -1)
        return np.cumsum(edge[:-1]) > 0
