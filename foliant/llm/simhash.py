"""SimHash near-duplicates, found with chains of segments around a ring.

Two fingerprints that differ in at most ``t`` of their bits are cut into ``m > t``
segments.  Some segment then starts a chain, going round, whose first ``l``
segments together differ in at most ``l * t / m`` bits, for every ``l``.  With
``l = 1`` that segment is equal, which is the key of the join; longer chains
discard most candidates before all bits are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, mapped, staged, text_rows
from .graph import components

# Rows of one key that one task compares; larger keys are cut into blocks, and
# pairs of blocks go to different tasks.
BLOCK_ROWS = 4096

# Rows of a key that are compared with all others at a time.
COMPARED_ROWS = 128

# Words of a text that are hashed at a time.
WORDS_AT_ONCE = 1 << 16


@dataclass(frozen=True)
class Setup:
    """Words per shingle, bits of a fingerprint (64 or 128), differing bits of a link.

    ``ratio`` is the least ratio of the shingle counts of two linked documents; 0
    links documents of any lengths.
    """

    words: int = 5
    bits: int = 128
    differing: int = 24
    ratio: float = 0.8

    def segments(self) -> list[tuple[int, int, int]]:
        """(word of the fingerprint, first bit, width) of every segment."""
        per_word = math.ceil((self.differing + 1) * 64 / self.bits)
        if per_word > 64:
            raise ValueError("more differing bits than a fingerprint has segments")
        limits = [round(i * 64 / per_word) for i in range(per_word + 1)]
        return [
            (word, low, high - low)
            for word in range(self.bits // 64)
            for low, high in zip(limits, limits[1:])
        ]


def fingerprints(
    docs: DataFrame, setup: Setup, key: str = "doc_id", text: str = "text", mark: str | None = None
) -> DataFrame:
    """``doc_id``, ``w0`` (and ``w1``): fingerprint words, ``n`` shingles, for every row.

    With ``mark``, a column of 64-bit integers, rows have it as ``mark`` as well.

    Words are runs of anything but ASCII white space, A-Z lower-cased; shingles
    count as often as they occur; a bit is one when it is set in over half of
    their XXH64 hashes (seed 42, and 43 for the second word).  A text with fewer
    words than a shingle has gives one shingle, a text without words none and a
    fingerprint of zeros.
    """
    size, seeds = setup.words, [42 + i for i in range(setup.bits // 64)]
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", *(f"w{i}" for i in range(len(seeds))), "n", *(["mark"] if mark else []))]
    )
    rows = text_rows(docs, key, text, *([F.col(mark).cast("long").alias("mark")] if mark else []))

    def bits_of(words: list[bytes]) -> tuple[list[int], int]:
        joined = [b" ".join(words)] if len(words) < size else None
        total, count = [np.zeros(64, np.int64) for _ in seeds], 0
        for start in range(0, 1 if joined else len(words) - size + 1, WORDS_AT_ONCE):
            part = joined or list(
                map(b" ".join, zip(*(words[start + i : start + i + WORDS_AT_ONCE] for i in range(size))))
            )
            part = part[: len(words) - size + 1 - start] if not joined else part
            count += len(part)
            for i, seed in enumerate(seeds):
                hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in part), "<u8", len(part))
                bytes_ = hashes.view(np.uint8).reshape(-1, 8)
                total[i] += np.unpackbits(bytes_, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return [int(np.packbits(t * 2 > count, bitorder="little").view("<i8")[0]) for t in total], count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out: list[list[int]] = [[] for _ in range(len(seeds) + 1)]
            for value in rows.column("text"):
                words = value.as_py().encode().lower().split()
                found, count = bits_of(words) if words else ([0] * len(seeds), 0)
                for column, x in zip(out, [*found, count]):
                    column.append(x)
            marks = [rows.column("mark")] if mark else []
            yield batch(schema, rows.column("doc_id"), *out, *marks)

    names = ", ".join(f"{f.name} long" for f in schema)
    return mapped(rows, run, names)


def _words(setup: Setup) -> list[str]:
    return [f"w{i}" for i in range(setup.bits // 64)]


def _length_class(n: Column, ratio: float) -> Column:
    """Classes such that two counts with at least the ratio are in one or neighbouring ones."""
    return F.floor(F.log(F.greatest(n, F.lit(1))) / math.log(1 / ratio) + 1e-9).cast("long")


def link(nodes: DataFrame, setup: Setup, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (``node``, words, ``n``).

    The links of a key are reduced to a spanning forest where they are found, so
    that a group of near copies gives as many links as it has members, not their
    square.  A key with more than ``block_rows`` rows is cut into blocks and every
    pair of blocks becomes a task of its own: nothing is left out.
    """
    words, segments = _words(setup), setup.segments()
    keyed = nodes.select(
        "node", *words, "n",
        F.explode(
            F.array(
                *[
                    F.shiftrightunsigned(F.col(words[w]), low).bitwiseAND((1 << width) - 1)
                    .bitwiseOR(F.lit(i << 34))
                    for i, (w, low, width) in enumerate(segments)
                ]
            )
        ).alias("key"),
    )
    if setup.ratio:
        own = _length_class(F.col("n"), setup.ratio)
        keyed = keyed.withColumn("length", F.explode(F.array(own, own + 1)))
        keyed = keyed.withColumn("key", F.col("key").bitwiseOR(F.shiftleft("length", 42)))
    large = keyed.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
    cut = keyed.join(large, "key").withColumn("blocks", F.ceil(F.col("rows") / block_rows).cast("int"))
    own = F.pmod(F.hash("node"), F.col("blocks"))
    dealt = cut.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    dealt = dealt.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", *words, "n"
    )
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return mapped(ordered, _linker(setup), "a long, b long").distinct()


def _linker(setup: Setup):
    segments, budget, ratio = setup.segments(), setup.differing, setup.ratio
    count, names = len(segments), _words(setup)
    lengths = sorted({min(count, x) for x in (2, 4, 8, 16)} - {count})

    def chain(start: int, length: int) -> tuple[list[int], int]:
        masks = [0] * len(names)
        for step in range(length):
            word, low, width = segments[(start + step) % count]
            masks[word] |= ((1 << width) - 1) << low
        return masks, length * budget // count

    chains = [[chain(s, n) for n in lengths] for s in range(count)]
    everything = ([(1 << 64) - 1] * len(names), budget)
    first_check = [c[0] if c else everything for c in chains]

    def differing(left, right, masks) -> np.ndarray:
        total = np.zeros(max(left[0].size, right[0].size), np.uint8)
        for x, y, mask in zip(left, right, masks):
            if mask:
                total += np.bitwise_count((x ^ y) & np.uint64(mask))
        return total

    def close(left, right, left_n, right_n, start: int) -> np.ndarray:
        """Positions of the linked ones of two aligned lists of fingerprints."""
        alive = np.arange(max(left[0].size, right[0].size))
        at = lambda x: x if x.size == 1 else x[alive]
        if ratio:
            low, high = np.minimum(left_n, right_n), np.maximum(left_n, right_n)
            alive = np.flatnonzero(np.broadcast_to(low >= ratio * high, alive.shape))
        for masks, most in [*chains[start], everything]:
            if not alive.size:
                break
            found = differing([at(x) for x in left], [at(x) for x in right], masks) <= most
            alive = alive[found]
        return alive

    def small_runs(run_id, start_of, words, n, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs at distance 1, 2, ... inside the runs, over all runs at once."""
        for step in range(1, most):
            left = np.flatnonzero(run_id[:-step] == run_id[step:]) if step < run_id.size else []
            if not len(left):
                return
            right = left + step
            for s in np.unique(start_of[left]):
                pick = start_of[left] == s
                a, b = left[pick], right[pick]
                hit = close([w[a] for w in words], [w[b] for w in words], n[a], n[b], int(s))
                yield a[hit], b[hit]

    def forest(words, n, start: int) -> Iterator[tuple[int, int]]:
        """Links of a spanning forest of one run: blocks of rows are compared with all rows behind.

        Only links between rows not connected yet are given, one per pair of their
        groups, so a dense group costs comparisons but no list of its pairs.
        """
        size = n.size
        parent, root = np.arange(size), np.arange(size)

        def find(x: int) -> int:
            while parent[x] != x:
                x = parent[x]
            return x

        masks, most = first_check[start]
        for low in range(0, size, COMPARED_ROWS):
            block = slice(low, low + COMPARED_ROWS)
            total = None
            for w, mask in zip(words, masks):
                if mask:
                    found = np.bitwise_count((w[block, None] ^ w[None, low:]) & np.uint64(mask))
                    total = found if total is None else total + found
            i, j = np.nonzero(total <= most)
            behind = i < j
            i, j = i[behind] + low, j[behind] + low
            open_ = root[i] != root[j]
            i, j = i[open_], j[open_]
            hit = close([w[i] for w in words], [w[j] for w in words], n[i], n[j], start)
            a, b = root[i[hit]], root[j[hit]]
            for pair in np.unique(np.minimum(a, b) * size + np.maximum(a, b)).tolist():
                a, b = find(pair // size), find(pair % size)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    yield a, b
            while (parent[root] != root).any():
                root = parent[root]

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        column = lambda c: table.column(c).to_numpy()
        key, i, j, node, n = (column(c) for c in ("key", "i", "j", "node", "n"))
        words = [column(c).view(np.uint64) for c in names]
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        sizes = np.diff(np.r_[new, key.size])
        run_id = np.repeat(np.arange(new.size), sizes)
        start_of = (key >> 34) & 0xFF
        few = sizes[run_id] <= 32
        rows = np.flatnonzero(few)
        for a, b in small_runs(run_id[rows], start_of[rows], [w[rows] for w in words], n[rows], 32):
            if a.size:
                yield batch(schema, node[rows[a]], node[rows[b]])
        for run in np.flatnonzero(sizes > 32):
            part = slice(new[run], new[run] + sizes[run])
            found = list(forest([w[part] for w in words], n[part], int(start_of[new[run]])))
            if found:
                a, b = np.array(found).T + new[run]
                yield batch(schema, node[a], node[b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole runs are handled together; at most one run and one batch are held.
        held: list[pa.RecordBatch] = []
        for rows in batches:
            if not rows.num_rows:
                continue
            held.append(rows)
            table = pa.Table.from_batches(held).combine_chunks()
            last = [table.column(c)[-1] for c in ("key", "i", "j")]
            key, i, j = (table.column(c).to_numpy() for c in ("key", "i", "j"))
            same = (key == last[0].as_py()) & (i == last[1].as_py()) & (j == last[2].as_py())
            cut = int(np.argmax(same))
            if cut:
                yield from pairs_of(table.slice(0, cut).combine_chunks())
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield from pairs_of(pa.Table.from_batches(held).combine_chunks())

    return run


def near_duplicates(
    docs: DataFrame, setup: Setup = Setup(), key: str = "doc_id", text: str = "text", mark: str | None = None
) -> DataFrame:
    """Every row with its fingerprint words, the ``root`` and the id of its group.

    ``component_id`` is the smallest id among all rows linked to this one over
    any number of links; rows with equal fingerprints are linked.  Rows with a
    null id take part, but do not name a group: a group of such rows alone has a
    null ``component_id``.  Repeated rows stay repeated.  Only distinct
    fingerprints are compared, so copies cost nothing.
    """
    prints = staged(fingerprints(docs, setup, key, text, mark), "fingerprints")
    words = _words(setup)
    node = F.col("w0") if len(words) == 1 else F.xxhash64(*words)
    # Equal fingerprints with different counts stay apart only where lengths matter.
    marks = [*words, "n"] if setup.ratio else words
    node = F.xxhash64(*marks) if setup.ratio else node
    kept = prints.withColumn("node", node)
    nodes = kept.groupBy("node", *words).agg(
        F.min("n").alias("n"), F.min("doc_id").alias("smallest")
    )
    nodes = staged(nodes, "distinct-fingerprints")
    roots = components(link(nodes, setup), "fingerprint-links")
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = rooted.join(names, "root").select("node", "root", "component_id")
    return kept.join(named, "node").drop("node")
