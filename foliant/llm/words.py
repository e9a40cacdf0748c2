"""Ids of texts put together from the ids of their words, with array operations."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class WordTable:
    """Ids of words met before, as bytes, for a worker; about ``remembered`` words.

    When half of these are new, those not met since the last time are forgotten.
    """

    def __init__(self, learn: Callable[[list[str]], dict[str, bytes]], remembered: int):
        self.learn, self.remembered = learn, remembered
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def find(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words; new ones are learned."""
        ids = list(map(self.known.get, words))
        absent = [w for w, x in zip(words, ids) if x is None]
        if absent:
            again = dict(zip(absent, map(self.before.get, absent)))
            fresh = [w for w, x in again.items() if x is None]
            again.update(self.learn(fresh) if fresh else {})
            if len(self.known) + len(again) > self.remembered // 2:
                self.known, self.before = {}, self.known
            self.known.update(again)
            ids = [again[w] if x is None else x for w, x in zip(words, ids)]
        return ids

    def ids(self, texts: pa.Array, separator: str) -> Iterator[bytes]:
        """Ids of every text, cut at each separator.

        Cutting, numbering the distinct words and putting ids in the words' places
        are array operations; only distinct words are looked up one by one.
        """
        cut = pc.split_pattern(texts, separator)
        numbered = cut.flatten().dictionary_encode()
        ids = self.find(numbered.dictionary.to_pylist())
        placed = pa.array(ids, pa.binary()).take(numbered.indices)
        if not len(placed):
            return
        data = memoryview(placed.buffers()[2] or b"")
        ends = np.frombuffer(placed.buffers()[1], np.int32)[cut.offsets.to_numpy()].tolist()
        for low, high in zip(ends, ends[1:]):
            yield bytes(data[low:high])


def in_portions(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """The texts in slices of about so many bytes, at least one text each."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield texts.slice(start, stop - start)
        pa.default_memory_pool().release_unused()
        start = stop
