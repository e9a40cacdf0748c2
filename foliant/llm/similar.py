"""Near copies by the similarity of their sets of shingles: candidates by prefixes, then confirmed.

Two sets with a Jaccard similarity of ``s`` or more, each in one order of all
shingles, have a shingle in common among the first ``n - ceil(s * n) + 1`` of each.
Any order is right; shingles that are common in a sample come last, so that
few sets meet at a common passage.  SimHashes put the candidates of a set in order, and every link is confirmed by the
shingles themselves.

First come the links that chains of segments around a ring find between SimHashes
(``simhash.link``): they are confirmed, and large and small stars make the first groups of
them.  Prefixes reach what is similar but farther apart, between those groups only.  A candidate is
discarded unseen when it cannot be similar: a bit of a sketch is the parity of the shingles
dealt to it, so two sketches differ in no more bits than their sets do in shingles.

Groups then grow in rounds.  Each round, every set that still has untried candidates outside
its group offers the nearest of them, one more for every candidate of its that was refuted
before.  So a group of alike sets is joined by a forest, not by all its pairs: what is
confirmed grows with the sets and the refuted candidates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, discard, mapped, staged, text_rows
from .graph import components, hooks
from .simhash import BLOCK_ROWS, COMPARED_ROWS, WORDS_AT_ONCE, link
from .simhash import Setup as Ring

# One text in SAMPLED is looked at for common shingles; those with COMMON
# occurrences there, and at most LISTED of them, come last.
SAMPLED, COMMON, LISTED = 16, 16, 1_000_000

# Sets of so many shingles or fewer are never discarded by their SimHashes; sketches do that.
SHORT = 256

# Pairs whose sketches are compared at a time.
AT_ONCE = 1 << 16

# Words of 64 bits in a sketch.
SKETCH = [f"x{i}" for i in range(4)]


@dataclass(frozen=True)
class Setup:
    """Words per shingle, least similarity of a link, differing bits of 128 that discard a candidate.

    Sets with a similarity of 0.8 differ in 19.4 bits, give or take 4.1; only sets of
    over ``SHORT`` shingles, for which that holds, are discarded by their bits.
    ``near`` differing bits of 64 make a link of the ring.
    """

    words: int = 5
    similarity: float = 0.8
    differing: int = 44
    near: int = 3


def shingles(text: bytes, size: int) -> np.ndarray:
    """Distinct XXH64 hashes (seed 42) of the runs of ``size`` words, in their order as unsigned numbers.

    Words are those of ``simhash.fingerprints``; a text with fewer gives one
    shingle, a text without words none.
    """
    words = text.lower().split()
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else [], np.uint64)
    count, found = len(words) - size + 1, []
    for start in range(0, count, WORDS_AT_ONCE):
        stop = min(start + WORDS_AT_ONCE, count)
        part = map(b" ".join, zip(*(words[start + i : stop + i] for i in range(size))))
        found.append(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in part), np.uint64, stop - start))
    return np.unique(np.concatenate(found))


def _simhash(hashes: np.ndarray) -> list[int]:
    """Two words of bits that over half of the hashes have set; the second from mixed hashes."""
    out = []
    for values in (hashes, _mixed(hashes)):
        total = np.zeros(64, np.int64)
        for low in range(0, values.size, WORDS_AT_ONCE):
            bits = values[low : low + WORDS_AT_ONCE].view(np.uint8).reshape(-1, 8)
            total += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(total * 2 > values.size, bitorder="little").view("<i8")[0]))
    return out


def _mixed(values: np.ndarray) -> np.ndarray:
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(factor)
    return values ^ (values >> np.uint64(31))


def _sketch(hashes: np.ndarray) -> list[int]:
    """Parity of the number of hashes that fall on each bit."""
    odd = np.bincount((hashes % np.uint64(64 * len(SKETCH))).astype(np.int64), minlength=64 * len(SKETCH)) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def _common(rows: DataFrame, size: int) -> np.ndarray:
    """Hashes of shingles that are common in the sampled texts, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64())])
        for part in batches:
            for value in part.column("text"):
                yield batch(schema, pa.array(shingles(value.as_py().encode(), size).view(np.int64)))

    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)
    counted = mapped(sample.select("text"), run, "key long").groupBy("key").agg(F.count("*").alias("n"))
    listed = counted.where(F.col("n") >= COMMON).orderBy(F.desc("n"), "key").limit(LISTED).select("key")
    return np.sort(listed.toArrow().column("key").to_numpy().astype(np.int64).view(np.uint64))


_PRINTS = pa.schema(
    [
        ("mark", pa.int64()), ("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()),
        ("w0", pa.int64()), ("w1", pa.int64()), *[(x, pa.int64()) for x in SKETCH], ("prefix", pa.list_(pa.int64())),
    ]
)
_PRINTS_SQL = f"mark long, doc_id long, node long, n long, w0 long, w1 long, {' long, '.join(SKETCH)} long, prefix array<long>"


def _prints(rows: DataFrame, setup: Setup) -> DataFrame:
    """Hash, size, SimHash, sketch and prefix of the set of every row."""
    common, size, least = _common(rows, setup.words), setup.words, setup.similarity

    def prefix(hashes: np.ndarray) -> np.ndarray:
        n = hashes.size - math.ceil(least * hashes.size - 1e-9) + 1
        if not hashes.size:
            return hashes
        if common.size:
            at = np.minimum(np.searchsorted(common, hashes), common.size - 1)
            last = common[at] == hashes
            hashes = np.concatenate([hashes[~last], hashes[last]])
        return hashes[:n]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            columns: list[list] = [[] for _ in range(5 + len(SKETCH))]
            for value in part.column("text"):
                hashes = shingles(value.as_py().encode(), size)
                node = np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).view(np.int64)
                found = (int(node), hashes.size, *_simhash(hashes), *_sketch(hashes), prefix(hashes).view(np.int64))
                for column, x in zip(columns, found):
                    column.append(x)
            yield batch(_PRINTS, part.column("mark"), part.column("doc_id"), *columns)

    return mapped(rows.select("mark", "doc_id", "text"), run, _PRINTS_SQL)


_OFFERS = pa.schema([("a", pa.int64()), ("d", pa.int32()), ("b", pa.int64()), ("wanted", pa.int32())])
_OFFERS_SQL = "a long, d int, b long, wanted int"

_PLACED = ["key", "i", "j", "node", "n", "pos", "w0", "w1", *SKETCH, "root", "d", "b", "wanted"]


def _offers(keyed: DataFrame, state: DataFrame, setup: Setup, block_rows: int) -> DataFrame:
    """The nearest untried candidates ``b`` of every set ``a`` in another group, ``wanted`` of each.

    ``state`` has ``node`` and ``root`` of the sets with candidates, and the last
    candidate each has tried: its distance ``d`` and node ``b``.  Keys within one
    group are left out; keys with more than ``block_rows`` rows are cut into pairs of blocks.
    """
    open_ = keyed.join(state, "node")
    counts = open_.groupBy("key").agg(
        F.count("*").alias("rows"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    mixed = counts.where("low < high").select("key", F.ceil(F.col("rows") / block_rows).cast("int").alias("blocks"))
    own = F.pmod(F.hash("node"), F.col("blocks"))
    dealt = open_.join(mixed, "key").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).select(*_PLACED)
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = mapped(ordered, _nearest(setup), _OFFERS_SQL).distinct()
    place = F.row_number().over(Window.partitionBy("a").orderBy("d", "b"))
    return found.withColumn("place", place).where("place <= wanted").select("a", "d", "b")


def _nearest(setup: Setup):
    share = setup.similarity / (1 + setup.similarity)

    def sketched(c: dict, i, j) -> np.ndarray:
        """Whether sketches differ in no more bits than the sets of a link may in shingles."""
        kept = np.zeros(i.size, bool)
        for low in range(0, i.size, AT_ONCE):
            x, y = i[low : low + AT_ONCE], j[low : low + AT_ONCE]
            bits = np.zeros(x.size, np.int16)
            for word in SKETCH:
                bits += np.bitwise_count(c[word][x] ^ c[word][y])
            kept[low : low + AT_ONCE] = bits <= (c["n"][x] + c["n"][y]) * (1 - 2 * share) + 1e-9
        return kept

    def untried(c: dict, i, j, d) -> np.ndarray:
        """Whether rows of two groups may be similar, by size and place, and neither has tried the other."""
        n, m, p, q = c["n"][i], c["n"][j], c["pos"][i], c["pos"][j]
        most = np.minimum(p, q) + np.minimum(n - p, m - q)
        need = np.maximum(np.ceil(share * (n + m) - 1e-9), setup.similarity * np.maximum(n, m) - 1e-9)
        kept = (most >= need) & (c["root"][i] != c["root"][j])
        kept &= (d <= setup.differing) | (np.minimum(n, m) <= SHORT)
        for x, y in ((i, j), (j, i)):
            kept &= (d > c["d"][x]) | ((d == c["d"][x]) & (c["node"][y] > c["b"][x]))
        return kept

    def distance(c: dict, i, j) -> np.ndarray:
        return (np.bitwise_count(c["w0"][i] ^ c["w0"][j]) + np.bitwise_count(c["w1"][i] ^ c["w1"][j])).astype(np.int32)

    def first(c: dict, i, j, d, run_id) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest candidates of every row of every run, as many as it wants."""
        by = np.lexsort((c["node"][j], d, i, run_id))
        i, j, d = i[by], j[by], d[by]
        new = np.r_[True, i[1:] != i[:-1]] if i.size else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        place = np.arange(i.size) - starts[np.cumsum(new) - 1]
        kept = place < c["wanted"][i]
        return i[kept], j[kept], d[kept]

    def small(c: dict, run_id: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))]
        for step in range(1, run_id.size):
            i = np.flatnonzero(run_id[:-step] == run_id[step:])
            if not i.size:
                break
            j = i + step
            d = distance(c, i, j)
            kept = untried(c, i, j, d)
            i, j, d = i[kept], j[kept], d[kept]
            kept = sketched(c, i, j)
            i, j, d = i[kept], j[kept], d[kept]
            found += [(i, j, d), (j, i, d)]
        i, j, d = map(np.concatenate, zip(*found))
        return first(c, i, j, d, run_id[i])

    def large(c: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        size = c["n"].size
        for low in range(0, size, COMPARED_ROWS):
            i = np.arange(low, min(low + COMPARED_ROWS, size))
            d = distance(c, i[:, None], np.arange(size)[None, :])
            x, j = np.nonzero(untried(c, i[:, None], np.arange(size)[None, :], d))
            kept = sketched(c, x + low, j)
            x, j = x[kept], j[kept]
            near = np.full(d.shape, 129, np.uint8)
            near[x, j] = d[x, j]
            d = near
            # Farther than the last place wanted, whatever the order of ties.
            last = np.minimum(c["wanted"][i], size) - 1
            limit = np.take_along_axis(np.sort(d, axis=1), last[:, None], axis=1)
            x, j = np.nonzero((d <= limit) & (d < 129))
            yield first(c, x + low, j, d[x, j].astype(np.int32), np.zeros(x.size, np.int8))

    def offers_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        c = {name: table.column(name).to_numpy() for name in _PLACED}
        c |= {x: c[x].view(np.uint64) for x in ("w0", "w1", *SKETCH)}
        new = np.flatnonzero(np.r_[True, np.any([c[x][1:] != c[x][:-1] for x in ("key", "i", "j")], axis=0)])
        sizes = np.diff(np.r_[new, c["key"].size])
        run_id = np.repeat(np.arange(new.size), sizes)

        def found() -> Iterator[tuple[dict, tuple]]:
            few = np.flatnonzero(sizes[run_id] <= 32)
            part = {name: values[few] for name, values in c.items()}
            yield part, small(part, run_id[few])
            for run in np.flatnonzero(sizes > 32):
                part = {name: values[new[run] : new[run] + sizes[run]] for name, values in c.items()}
                yield from ((part, x) for x in large(part))

        for part, (i, j, d) in found():
            if i.size:
                yield batch(_OFFERS, part["node"][i], d, part["node"][j], part["wanted"][i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole runs are handled together; at most one run and one batch are held.
        held: list[pa.RecordBatch] = []
        for rows in batches:
            if not rows.num_rows:
                continue
            held.append(rows)
            last = [rows.column(c)[-1].as_py() for c in ("key", "i", "j")]
            table = pa.Table.from_batches(held).combine_chunks()
            same = np.all([table.column(c).to_numpy() == x for c, x in zip(("key", "i", "j"), last)], axis=0)
            cut = int(np.argmax(same))
            if cut:
                yield from offers_of(table.slice(0, cut).combine_chunks())
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield from offers_of(pa.Table.from_batches(held).combine_chunks())

    return run


def _sets(ends: DataFrame, rows: DataFrame, marks: DataFrame, size: int) -> DataFrame:
    """The shingles of every node in ``ends``, made again from a text that has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("hashes", pa.list_(pa.int64()))])
        for part in batches:
            sets = [shingles(v.as_py().encode(), size).view(np.int64) for v in part.column("text")]
            yield batch(schema, part.column("node"), sets)

    texts = rows.select("mark", "text").join(marks.join(ends, "node"), "mark").select("node", "text")
    return mapped(texts, run, "node long, hashes array<long>").dropDuplicates(["node"])


def _pairs(offers: DataFrame) -> DataFrame:
    """The pairs ``a`` < ``b`` of the offers, their distance, and whether ``a`` or ``b`` has offered."""
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    sides = offers.select(*ends, "d", (F.col("a") < F.col("b")).alias("low"))
    return sides.groupBy("a", "b").agg(F.max("d").alias("d"), F.bool_or("low").alias("of_a"), F.bool_or(~F.col("low")).alias("of_b"))


def _tried(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs, and whether their sets have the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    similar = both / (F.size("x") + F.size("y") - both) >= similarity
    return pairs.join(left, "a").join(right, "b").select(*pairs.columns, similar.alias("linked"))


def _after(state: DataFrame, tried: DataFrame) -> DataFrame:
    """The sets that made offers, with their new groups and the last candidate each has tried.

    Groups are hung together in one step, so that one may still go by two roots: that costs
    a trial more, while stars to the end would cost every round some passes more.
    """
    sides = F.array(
        F.struct(F.col("of_a").alias("of"), F.col("a").alias("node"), F.col("b").alias("b")),
        F.struct(F.col("of_b").alias("of"), F.col("b").alias("node"), F.col("a").alias("b")),
    )
    told = tried.select("d", "linked", F.explode(sides).alias("s")).where("s.of").select("s.node", "d", "s.b", "linked")
    last = told.groupBy("node").agg(F.max(F.struct("d", "b")).alias("last"), F.count_if(~F.col("linked")).alias("refuted"))
    of, linked = state.select("node", "root"), tried.where("linked").select("a", "b")
    roots = linked.join(of.toDF("a", "x"), "a").join(of.toDF("b", "y"), "b")
    moved = hooks(roots.select(F.col("x").alias("a"), F.col("y").alias("b")))
    joined = state.select("node", "root", "wanted").join(last, "node")
    joined = joined.join(moved.toDF("root", "moved"), "root", "left")
    return joined.select(
        "node", F.coalesce("moved", "root").alias("root"), "last.d", "last.b",
        (F.col("wanted") + F.col("refuted")).cast("int").alias("wanted"),
    )


def _ring(nodes: DataFrame, rows: DataFrame, marks: DataFrame, setup: Setup, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """The links ``a``, ``b`` of the ring that their shingles confirm, and the sets of its ends."""
    found = link(nodes.select("node", "w0", "n"), Ring(setup.words, 64, setup.near, ratio=0), block_rows)
    ring = staged(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "ring-links")
    ends = ring.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = staged(_sets(ends, rows, marks, setup.words), "shingle-sets")
    tried = staged(_tried(ring, sets, setup.similarity), "tried-pairs")
    discard(ring)
    return tried.where("linked").select("a", "b"), sets


def near_duplicates(
    docs: DataFrame,
    setup: Setup = Setup(),
    key: str = "doc_id",
    text: str = "text",
    mark: str = "mark",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``mark``, ``doc_id`` and the ``root`` of its group, for every row.

    Rows are linked when the Jaccard similarity of their distinct shingles is at
    least ``setup.similarity``; groups are closed over any number of links.  Rows
    with equal sets are one group, rows without words too.  ``mark`` is a
    64-bit hash of id and text.  The ring makes the first groups; every candidate between two
    groups is tried before the rounds end; those inside one group need no trial.
    """
    rows = text_rows(docs, key, text, F.col(mark).cast("long").alias("mark"))
    prints = staged(_prints(rows, setup), "shingle-prints")
    nodes = prints.select("node", "n", "w0", "w1", *SKETCH).distinct()
    marks = prints.groupBy("node").agg(F.min("mark").alias("mark"))
    # Equal sets have equal prefixes.
    places = prints.join(marks, ["node", "mark"], "left_semi").select("node", F.posexplode("prefix").alias("pos", "key"))
    places = staged(places.distinct(), "prefixes")
    shared = places.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
    keyed = staged(places.join(shared.select("key"), "key").join(nodes, "node"), "shared-prefixes")
    discard(places)
    linked, sets = _ring(nodes, rows, marks, setup, block_rows)
    groups = components(linked, "ring-groups")
    none = {"d": F.lit(-1), "b": F.lit(0).cast("long"), "wanted": F.lit(1)}
    opened = keyed.select("node").distinct().join(groups, "node", "left")
    state = staged(opened.select("node", F.coalesce("root", "node").alias("root")).withColumns(none), "open-sets")
    links, made = [linked], [sets]
    while True:
        offers = staged(_offers(keyed, state, setup, block_rows), "offers")
        if offers.isEmpty():
            break
        pairs = _pairs(offers)
        if len(made) == 1:
            # Whatever has a candidate outside its group makes an offer in the first round.
            ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(sets, "node", "left_anti")
            made.append(staged(_sets(ends, rows, marks, setup.words), "shingle-sets"))
            sets = sets.unionByName(made[1])
        tried = staged(_tried(pairs, sets, setup.similarity), "tried-pairs")
        links.append(tried.where("linked").select("a", "b"))
        before, state = state, staged(_after(state, tried), "open-sets")
        discard(before, offers)
    discard(keyed, state, offers, *made)
    all_links = links[0]
    for more in links[1:]:
        all_links = all_links.unionByName(more)
    roots = components(all_links, "similar-groups").withColumnRenamed("root", "found")
    grouped = prints.select("mark", "doc_id", "node").join(roots, "node", "left")
    return grouped.select("mark", "doc_id", F.coalesce("found", "node").alias("root"))
