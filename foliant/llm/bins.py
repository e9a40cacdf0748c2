"""Documents packed into as few sequences of a fixed size as best-two-fit finds.

A sequence is filled greedily: the longest piece that fits, again and again.
Then its smallest piece is taken out again wherever two pieces that are still
unpacked fill the gap it leaves more tightly.  Pieces of one length are alike to
this method, so it works on the numbers of pieces per length, of which there are
as many as a sequence has tokens, and fills equal sequences together.  Spark
numbers the pieces of every length and gives each its place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, mapped, staged, text_rows
from .tokens import encoder

# Words whose ids a worker remembers, and ids that a task sends on at a time.
REMEMBERED = 500_000
AT_ONCE = 1 << 21


@dataclass(frozen=True)
class Filling:
    """``times`` sequences that all hold pieces of these lengths, in this order."""

    lengths: tuple[int, ...]
    times: int


def _fill(left: np.ndarray, room: int) -> list[int]:
    """Lengths of the pieces of one sequence, longest first; they are taken out of ``left``."""
    inside: list[int] = []
    free = room
    while free > 0:
        fits = np.flatnonzero(left[: free + 1])
        if not fits.size:
            break
        longest = int(fits[-1])
        some = min(int(left[longest]), free // longest)
        left[longest] -= some
        free -= longest * some
        inside += [longest] * some
    return inside


def _best_two(left: np.ndarray, smallest: int, gap: int) -> tuple[int, int] | None:
    """The two unpacked pieces that fill most of the gap, if more than the smallest piece does.

    Of pairs that fill it alike the one with the longest piece is taken.
    """
    there = np.flatnonzero(left[: gap + 1])
    if not there.size:
        return None
    # For every longer one of the two the longest partner that is not longer and still fits.
    partner = np.minimum(there, gap - there)
    at = np.searchsorted(there, partner, side="right") - 1
    alone = (at >= 0) & (there[at] == there) & (left[there] < 2)
    at = at - alone
    total = np.where(at >= 0, there + there[np.maximum(at, 0)], 0)
    best = int(len(total) - 1 - np.argmax(total[::-1]))
    if total[best] <= smallest:
        return None
    return int(there[best]), int(there[at[best]])


def best_two_fit(counts: dict[int, int], room: int) -> list[Filling]:
    """Fillings that hold ``counts[length]`` pieces of every length once.

    The next sequence is filled alike as long as the pieces are left that were put in, the
    one that was taken out again among them; so a filling is repeated until one of these lengths
    runs short.  Then no more of it are left than fit into a sequence, and at most half as many
    each further time; so there are at most about two and a half fillings per token of
    ``room``, whatever the input.
    """
    left = np.zeros(room + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    fillings = []
    while left.any():
        before = left.copy()
        inside = _fill(left, room)
        needed = before - left
        if len(inside) > 1 and sum(inside) < room:
            smallest = inside[-1]
            pair = _best_two(left, smallest, room - sum(inside) + smallest)
            if pair:
                inside[-1:] = pair
                needed = needed + np.bincount(pair, minlength=room + 1)
        taken = np.bincount(inside, minlength=room + 1)
        used = taken > 0
        times = int(((before[used] - needed[used]) // taken[used]).min()) + 1
        left = before - taken * times
        fillings.append(Filling(tuple(sorted(inside, reverse=True)), times))
    return fillings


class Places:
    """Sequence and offset of the nth piece of every length, by a search in sorted arrays."""

    def __init__(self, fillings: list[Filling], room: int):
        entries: list[tuple[int, int, int, int, int]] = []
        reached = np.zeros(room + 1, np.int64)
        sequence = 0
        for filling in fillings:
            offset = 0
            for length in dict.fromkeys(filling.lengths):
                alike = filling.lengths.count(length)
                entries.append((length, int(reached[length]), alike, sequence, offset))
                reached[length] += alike * filling.times
                offset += alike * length
            sequence += filling.times
        self.sequences = sequence
        table = np.array(sorted(entries), np.int64).reshape(-1, 5)
        self.length, self.first, self.alike, self.sequence, self.offset = table.T.copy()
        self.starts = np.searchsorted(self.length, np.arange(room + 2))

    def find(self, length: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For pieces of these lengths, each the nth (from 0) of its length."""
        at = np.zeros(len(length), np.int64)
        for one in np.unique(length):
            mine = length == one
            low, high = self.starts[one], self.starts[one + 1]
            at[mine] = low + np.searchsorted(self.first[low:high], nth[mine], side="right") - 1
        ahead = nth - self.first[at]
        return self.sequence[at] + ahead // self.alike[at], self.offset[at] + ahead % self.alike[at] * length


def cut(n: int, room: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document; only the first may be shorter than ``room``."""
    first = (n - 1) % room + 1
    return [(0, first)] + [(at, room) for at in range(first, n, room)]


_PIECES = "doc_id long, piece int, start long, length int, ids binary"
_FIELDS = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids", pa.binary())]


def pieces(
    docs: DataFrame, tokenizer: str, room: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Token ids of every document, the end id behind them, in pieces of at most ``room`` ids.

    Columns: ``doc_id``, ``piece`` (from 0), ``start``, ``length`` and ``ids``
    (unsigned 32-bit integers, little-endian); and ``part`` and ``nth``, the task that
    made the piece and how many of this length it made before.
    """
    schema = pa.schema([*_FIELDS, ("part", pa.int32()), ("nth", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, REMEMBERED)
        part = TaskContext.get().partitionId()
        seen = [0] * (room + 1)
        held: list[tuple] = []
        size = 0
        for rows in batches:
            for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encode(rows.column("text"))):
                ids += end
                for number, (start, length) in enumerate(cut(len(ids) // 4, room)):
                    held.append((doc_id, number, start, length, ids[4 * start : 4 * (start + length)], part, seen[length]))
                    seen[length] += 1
                    size += length
                    if size >= AT_ONCE:
                        yield batch(schema, *map(list, zip(*held)))
                        held, size = [], 0
        if held:
            yield batch(schema, *map(list, zip(*held)))

    return mapped(text_rows(docs, key, text), run, f"{_PIECES}, part int, nth long")


def pack(
    docs: DataFrame, tokenizer: str, room: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and its ``offset`` in it.

    Columns: ``doc_id``, ``piece``, ``start``, ``length``, ``ids``, ``sequence_id``,
    ``offset``.  A document is the ids of its whole text and ``end_id``; null and empty
    texts are the end id alone, null ids stay, repeated rows are packed each, other
    columns are left out, no rows give no rows.  Sequences are numbered from 0
    without gaps, and pieces lie in them without gaps.

    The numbers per length that reach the driver are ``room`` at most.  A piece is
    numbered among those of its length by its task, which adds the pieces of the tasks
    before; so a length that most pieces have is no large group.
    """
    made = staged(pieces(docs, tokenizer, room, end_id, key, text), "pieces")
    sizes = staged(made.groupBy("length", "part").agg(F.count("*").alias("rows")), "piece-counts")
    totals = sizes.groupBy("length").agg(F.sum("rows").alias("rows")).collect()
    places = Places(best_two_fit({r["length"]: r["rows"] for r in totals}, room), room)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    schema = pa.schema([*_FIELDS, ("sequence_id", pa.int64()), ("offset", pa.int32())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows:
                nth = rows.column("nth").to_numpy() + rows.column("before").to_numpy()
                found = places.find(rows.column("length").to_numpy(), nth)
                yield batch(schema, *rows.columns[: len(_FIELDS)], *map(pa.array, found))

    joined = made.join(before, ["length", "part"]).select(*[n for n, _ in _FIELDS], "nth", "before")
    return mapped(joined, place, f"{_PIECES}, sequence_id long, offset int")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``ids`` of its pieces in order, their ``lengths``."""
    grouped = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("inside")
    )
    joined = F.aggregate("inside", F.lit(b"").cast("binary"), lambda x, p: F.concat(x, p["ids"]))
    return grouped.select("sequence_id", joined.alias("ids"), F.col("inside.length").alias("lengths"))
