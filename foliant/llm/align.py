"""Tokens of two tokenizers grouped by the bytes they cover.

Token ends of both are places among the same bytes.  Every token points to its
farthest-right overlapping token, which is the other tokenizer's token over its last
byte; where both end together the chain ends.  Doubling all pointers at once, until
none changes, leads every token to the last token of its connected component,
whose number labels the group.  All documents of a batch are doubled together.

How many documents link a pair of ids is counted over the corpus.  Tasks cut their
documents into blocks and send on the distinct pairs of each block with their
numbers of documents; the sums come back to the blocks the same way, so a pair
travels once per block and not once per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, mapped, per_process, staged, text_rows
from .tokens import Encoder
from .words import WordTable, in_portions

SPACE = "▁"

# Words whose ids a worker remembers for each tokenizer.
REMEMBERED = 400_000

# Bytes of text that are aligned together, and links that are written out at a time.
AT_ONCE = 1 << 20
LINKS_AT_ONCE = 1 << 20

# Pairs of documents and ids in a block, at which it ends.
BLOCK = 1 << 21

# Bits of an id of the second tokenizer in a pair.
BITS = 32


class BytePieces(Encoder):
    """The byte-level tokenizer; strings of special tokens are plain text."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        super().__init__(path, remembered)
        self.tokenizer.encode_special_tokens = True
        # Fixed values of byte-level vocabularies: printable bytes stand for
        # themselves, the others for the characters from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.shown = [bytes(byte_of.get(c, 0) for c in name or "") for name in names]


class MergedPieces:
    """The public library's piece tokenizer; words met before are looked up.

    A text is cut at its spaces where no piece goes on over one; texts with runs of
    spaces, and those that begin or end with one, go to the library whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        self.shown = [
            bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(names)
        ]
        self.by_words = not any(SPACE in p.lstrip(SPACE) for p in names)
        self.table = WordTable(self.learn, remembered)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x, "<u4").tobytes() for x in self.library.encode(texts, num_threads=1)]

    def learn(self, fresh: list[str]) -> dict[str, bytes]:
        return dict(zip(fresh, self.whole(fresh)))

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        for part in in_portions(texts, AT_ONCE):
            odd = pc.match_substring_regex(part, f"^$|^ | $|  |{SPACE}" if self.by_words else "")
            found = self.table.ids(part.filter(pc.invert(odd)), " ")
            for text, whole in zip(part, odd.to_pylist()):
                yield self.whole([text.as_py()])[0] if whole else next(found)


def _numbers(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids laid end to end, and where each document's begin (one place more)."""
    places = np.cumsum([0, *(len(x) // 4 for x in ids)])
    return np.frombuffer(b"".join(ids), "<u4").astype(np.int64), places


@dataclass
class Groups:
    """Tokens of two tokenizers over the same bytes: group of every token, numbered from 0."""

    of_a: np.ndarray
    of_b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray


def linked(ends_a: np.ndarray, ends_b: np.ndarray) -> Groups:
    """Groups of overlapping tokens by pointer jumping; ``ends`` ascend and end alike."""
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a, side="left")
    over_b = np.searchsorted(ends_a, ends_b, side="left")
    last = ends_a[over_b] == ends_b
    points = np.r_[over_a + n, np.where(last, np.arange(len(ends_b)) + n, over_b)]
    while True:
        farther = points[points]
        if np.array_equal(farther, points):
            break
        points = farther
    terminal = np.flatnonzero(last) + n
    of = np.searchsorted(terminal, points)
    of_a, of_b = of[:n], of[n:]
    groups = np.arange(len(terminal) + 1)
    return Groups(of_a, of_b, np.searchsorted(of_a, groups), np.searchsorted(of_b, groups))


def links(a: np.ndarray, b: np.ndarray, groups: Groups, most: int = LINKS_AT_ONCE) -> Iterator[tuple]:
    """Linked occurrences: group, pair of ids, and how often the pair occurs there, in portions.

    A group with more links than a portion gives its distinct pairs with their numbers.
    """
    wide = np.diff(groups.first_b)
    tall = np.diff(groups.first_a)
    total = wide * tall
    small = total <= most
    upto = np.cumsum(np.where(small, total, 0))
    low = 0
    while low < len(total):
        base = upto[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(upto, base + most, side="right")))
        some = np.flatnonzero(small[groups.of_a[groups.first_a[low] : groups.first_a[high]]]) + groups.first_a[low]
        of = groups.of_a[some]
        times = wide[of]
        number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        other = np.repeat(groups.first_b[of], times) + number
        yield np.repeat(of, times), (np.repeat(a[some], times) << BITS) | b[other], np.ones(len(other), np.int64)
        low = high
    for g in np.flatnonzero(~small).tolist():
        ids_a, n_a = np.unique(a[groups.first_a[g] : groups.first_a[g + 1]], return_counts=True)
        ids_b, n_b = np.unique(b[groups.first_b[g] : groups.first_b[g + 1]], return_counts=True)
        rows = max(1, most // len(ids_b))
        for at in range(0, len(ids_a), rows):
            pairs = ((ids_a[at : at + rows, None] << BITS) | ids_b).ravel()
            yield np.full(len(pairs), g), pairs, (n_a[at : at + rows, None] * n_b).ravel()


class Texts:
    """Ids as decimal text between the marks of the digest: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, n_a: int, n_b: int):
        names_a, names_b = [str(i) for i in range(n_a)], [str(i) for i in range(n_b)]
        self.n_a, self.n_b = n_a, n_b
        self.table = pa.array(
            [x + m for m in (",", "|") for x in names_a] + [x + m for m in (",", ";", "") for x in names_b], pa.binary()
        )

    def digests(self, a, b, groups: Groups, doc_a: np.ndarray, doc_b: np.ndarray) -> list[str]:
        """SHA-256 of every document's groups; ``doc_a``, ``doc_b``: where its tokens begin."""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[groups.first_a[1:] - 1] = 1
        last_b[groups.first_b[1:] - 1] = 1
        last_b[doc_b[1:] - 1] = 2
        order = np.zeros(len(a) + len(b), np.int64)
        # A group's tokens stand together, its first tokenizer's before its second's.
        order[np.arange(len(a)) + groups.first_b[groups.of_a]] = a + last_a * self.n_a
        order[np.arange(len(b)) + groups.first_a[groups.of_b + 1]] = b + last_b * self.n_b + 2 * self.n_a
        shown = self.table.take(pa.array(order))
        data, ends = memoryview(shown.buffers()[2]), np.frombuffer(shown.buffers()[1], np.int32)
        places = ends[doc_a + doc_b].tolist()
        return [hashlib.sha256(data[low:high]).hexdigest() for low, high in zip(places, places[1:])]


class Aligner:
    """Both tokenizers, and what their ids stand for."""

    def __init__(self, first: str, second: str):
        self.a, self.b = BytePieces(first), MergedPieces(second)
        self.shown_a, self.shown_b = pa.array(self.a.shown, pa.binary()), pa.array(self.b.shown, pa.binary())
        self.size_a = np.array([len(x) for x in self.a.shown])
        self.size_b = np.array([len(x) for x in self.b.shown])
        self.texts = Texts(len(self.a.shown), len(self.b.shown))

    def kept(self, texts: pa.Array) -> tuple[np.ndarray, list[bytes], list[bytes]]:
        """Places of the texts that both tokenizers give back byte for byte, and their ids."""
        spaced = pc.binary_join_element_wise(" ", texts, "")
        ids_a, ids_b = list(self.a(spaced)), list(self.b(texts))
        wanted = spaced.cast(pa.binary())
        same = pc.not_equal(texts, "").to_numpy(zero_copy_only=False)
        for ids, shown, size in ((ids_a, self.shown_a, self.size_a), (ids_b, self.shown_b, self.size_b)):
            flat, places = _numbers(ids)
            joined = shown.take(pa.array(flat)).buffers()[2] if len(flat) else None
            ends = np.r_[0, np.cumsum(size[flat])][places].tolist()
            data = memoryview(joined or b"")
            same &= [data[x:y] == t.as_buffer() for x, y, t in zip(ends, ends[1:], wanted)]
        some = np.flatnonzero(same)
        return some, [ids_a[i] for i in some], [ids_b[i] for i in some]


def aligner(first: str, second: str) -> Aligner:
    return per_process(f"align {first} {second}", lambda: Aligner(first, second))


def planes(values: np.ndarray) -> bytes:
    """Numbers as four rows of bytes, lowest first, which compress better than numbers."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(rows.T).view("<u4").ravel().astype(np.int64)


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


class Block:
    """Documents of a task until they hold enough pairs: counts, digest, and pairs as places in the block's list."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def add(self, row: tuple, pairs: np.ndarray, times: np.ndarray) -> None:
        self.rows.append(row)
        self.pairs.append(pairs)
        self.times.append(times)
        self.size += len(pairs) + 1

    def close(self) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """Rows with their places and numbers, the distinct pairs, and the documents of each."""
        every = np.concatenate(self.pairs) if self.pairs else np.zeros(0, np.int64)
        distinct, places, documents = np.unique(every, return_inverse=True, return_counts=True)
        rows, at = [], 0
        for row, pairs, times in zip(self.rows, self.pairs, self.times):
            own = places[at : at + len(pairs)]
            at += len(pairs)
            rows.append((*row, planes(np.diff(own, prepend=0)), planes(times)))
        return rows, distinct, documents


def _documents(own: Aligner, doc_ids: list, texts: pa.Array, most: int) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """Counts and digest of every text, its distinct pairs in ascending order, and how often each occurs."""
    some, ids_a, ids_b = own.kept(texts)
    (a, doc_a), (b, doc_b) = _numbers(ids_a), _numbers(ids_b)
    none = np.zeros(0, np.int64)
    if len(some):
        groups = linked(np.cumsum(own.size_a[a]), np.cumsum(own.size_b[b]))
        digests = own.texts.digests(a, b, groups, doc_a, doc_b)
        doc_of = np.searchsorted(doc_a, groups.first_a[:-1], side="right") - 1
        n_groups = np.bincount(doc_of, minlength=len(some))
        total = np.diff(groups.first_a) * np.diff(groups.first_b)
        n_links = np.add.reduceat(total, np.searchsorted(doc_of, np.arange(len(some))))
        found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in some]
        for of, pairs, times in links(a, b, groups, most):
            docs = doc_of[of]
            # Links of a document stand together; its pairs are added up in order.
            order = np.lexsort((pairs, docs))
            docs, pairs, times = docs[order], pairs[order], times[order]
            new = np.r_[True, (docs[1:] != docs[:-1]) | (pairs[1:] != pairs[:-1])] if len(docs) else none.astype(bool)
            first = np.flatnonzero(new)
            docs, pairs, times = docs[first], pairs[first], np.add.reduceat(times, first) if len(first) else times
            cuts = np.searchsorted(docs, np.arange(docs[0], docs[-1] + 2)) if len(docs) else []
            for d, low, high in zip(range(docs[0], docs[-1] + 1) if len(docs) else [], cuts, cuts[1:]):
                found[d].append((pairs[low:high], times[low:high]))
    place = dict(zip(some.tolist(), range(len(some))))
    for i, doc_id in enumerate(doc_ids):
        d = place.get(i)
        if d is None:
            yield (doc_id, 0, 0, 0, 0, ""), none, none
            continue
        pairs, times = found[d][0] if len(found[d]) == 1 else map(np.concatenate, zip(*found[d]))
        if len(found[d]) > 1:
            pairs, at = np.unique(pairs, return_inverse=True)
            times = np.bincount(at, weights=times).astype(np.int64)
        row = (doc_id, int(doc_a[d + 1] - doc_a[d]), int(doc_b[d + 1] - doc_b[d]), int(n_groups[d]), int(n_links[d]), digests[d])
        yield row, pairs, times


def align(
    docs: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """Groups and links of every document's tokens under two tokenizers.

    ``first`` is a byte-level tokenizer file, which gets a space and the text, ``second`` a
    piece model file, which adds the space itself.  Columns: ``doc_id``; ``n_a``, ``n_b``, numbers
    of tokens; ``n_groups``, of groups between byte places where tokens of both end;
    ``n_links``, of pairs of tokens inside a group; ``n_best``, of links whose pair of ids
    occurs in as many documents as any pair of its first id; ``count_sum``, the
    documents of the pairs of all links, added up; ``groups_sha256``, the hash of the groups.

    Null and empty texts, and those that one tokenizer does not give back byte for
    byte, have zeros and an empty hash.  Null ids stay, repeated rows are
    documents each, other columns are left out, no rows give no rows.  ``block`` bounds
    the pairs that a task or a group holds.
    """
    schema = pa.schema(
        [("block", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("groups_sha256", pa.string()),
         ("places", pa.binary()), ("times", pa.binary()), ("pair", pa.int64()), ("documents", pa.int64())]
    )

    def closed(number: int, held: Block) -> Iterator[pa.RecordBatch]:
        rows, distinct, documents = held.close()
        for low in range(0, len(rows), 1000):
            part = list(zip(*rows[low : low + 1000]))
            n = len(part[0])
            yield batch(schema, [number] * n, *map(list, part), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()))
        for low in range(0, len(distinct), 1 << 18):
            pairs = distinct[low : low + (1 << 18)]
            n = len(pairs)
            none = [pa.nulls(n, f.type) for f in list(schema)[1:-2]]
            numbers = pa.array(np.full(n, number))
            yield batch(schema, numbers, *none, pa.array(pairs), pa.array(documents[low : low + n]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(first, second)
        number = TaskContext.get().partitionId() << 32
        held = Block()
        for rows in batches:
            ids, at = rows.column("doc_id").to_pylist(), 0
            for part in in_portions(rows.column("text"), AT_ONCE):
                for row, pairs, times in _documents(own, ids[at : at + len(part)], part, LINKS_AT_ONCE):
                    held.add(row, pairs, times)
                    if held.size >= block:
                        yield from closed(number, held)
                        number, held = number + 1, Block()
                at += len(part)
        if held.rows:
            yield from closed(number, held)

    fields = f"block long, doc_id long, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string, places binary, times binary"
    made = staged(mapped(text_rows(docs, key, text), run, f"{fields}, pair long, documents long"), "alignments")
    rows = made.where(F.col("groups_sha256").isNotNull()).drop("pair", "documents")
    pairs = made.where(F.col("pair").isNotNull()).select("block", "pair", "documents")
    counts = staged(pairs.groupBy("pair").agg(F.sum("documents").alias("count")), "pair-counts")
    of = F.shiftright("pair", BITS).alias("of")
    # At most one row per id of the first vocabulary.
    highest = counts.groupBy(of).agg(F.max("count").alias("highest"))
    judged = counts.join(highest, counts["pair"].bitwiseAND(-(1 << BITS)) == F.shiftleft(highest["of"], BITS))
    judged = judged.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    back = pairs.select(F.col("block").alias("to"), "pair").join(judged, "pair")
    result = f"doc_id long, {', '.join(f'{c} long' for c in _COUNTS)}, n_best long, count_sum long, groups_sha256 string"

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pair").to_numpy())
        count, best = right.column("count").to_numpy()[order], right.column("best").to_numpy()[order]
        n_best, count_sum = [], []
        for places, times in zip(left.column("places"), left.column("times")):
            at, n = np.cumsum(from_planes(places.as_py())), from_planes(times.as_py())
            n_best.append(int(n[best[at]].sum()))
            count_sum.append(int((count[at] * n).sum()))
        own = [left.column(c) for c in ("doc_id", *_COUNTS)]
        added = [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())]
        return pa.table([*own, *added, left.column("groups_sha256")], ["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    return rows.groupBy("block").cogroup(back.groupBy("to")).applyInArrow(summed, result)
