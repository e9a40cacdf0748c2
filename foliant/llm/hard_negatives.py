"""Hard negatives by Fagin's threshold algorithm over sorted lists of every dimension.

Rows lie in shards of one label.  A shard keeps its rows' places sorted by every
dimension.  An anchor walks down all lists at once, from the largest component where
its own is positive and from the smallest where it is negative; every row it meets
for the first time is scored at random access.  What no list has shown yet scores at
most the threshold, the anchor's product with the components the walks stand at, so
the search ends once that is strictly below the worst score that each of the
anchor's windows still asks for.  Scores are integers, and results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, mapped, staged

# Scores beyond this are held at it; no real score of a table of floats near one comes there.
MOST = 1 << 62

# Integers up to this are exact in double precision.
EXACT = 1 << 53


@dataclass(frozen=True)
class Settings:
    """What is mined, and how rows travel.

    Components become floor(``scale`` x); an anchor has ``positives`` positives, each with
    ``negatives`` negatives of ``low`` to ``high`` hundredths of its score.  ``shard`` rows
    share sorted lists, ``anchors`` anchors go to a shard together, and lists are read
    ``step`` rows deep at first, twice as deep each time.
    """

    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    shard: int = 8192
    anchors: int = 2048
    step: int = 32


class Lists:
    """Rows of a shard, and their places sorted by every dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray):
        self.ids, self.vectors, self.order = ids, vectors, order
        self.size, self.width = vectors.shape
        self.largest = int(np.abs(vectors).max(initial=0))
        self.floats = vectors.astype(np.float64)

    @staticmethod
    def sorted_places(vectors: np.ndarray) -> np.ndarray:
        """Places in ascending order of the component, a row per dimension."""
        return np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32).copy()

    def scores(self, places: np.ndarray | slice, anchor: np.ndarray) -> np.ndarray:
        """Integer inner products, however large the components are."""
        bound = self.width * self.largest * int(np.abs(anchor).max(initial=0))
        if bound < EXACT:
            return (self.floats[places] @ anchor.astype(np.float64)).astype(np.int64)
        if bound < MOST:
            return self.vectors[places] @ anchor
        whole = self.vectors[places].astype(object) @ anchor.astype(object)
        return np.array([min(max(x, -MOST), MOST) for x in whole], np.int64)

    def threshold(self, depth: int, dims: np.ndarray, anchor: np.ndarray) -> int:
        """The most that a row can score that no list has shown down to this depth."""
        at = np.where(anchor[dims] > 0, self.size - depth, depth - 1)
        reached = self.vectors[self.order[dims, at], dims]
        return sum(a * x for a, x in zip(anchor[dims].tolist(), reached.tolist()))

    def search(
        self, anchor: np.ndarray, own: int, windows: Sequence[tuple[int, int]], wanted: int, step: int
    ) -> list[tuple[int, int, int]]:
        """The best ``wanted`` rows of every window: its number, id, score; equal scores by smaller id.

        A window is a least and a greatest score.  Rows with the id ``own`` are left out.
        """
        dims = np.flatnonzero(anchor)
        seen = np.zeros(self.size, bool)
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2 for _ in windows]
        depth = 0
        while True:
            # Sorted access, down to the new depth in every list.
            deeper = min(max(step, 2 * depth), self.size) if dims.size else self.size
            part = np.zeros(self.size, bool)
            for d in dims.tolist():
                row = self.order[d]
                part[row[self.size - deeper : self.size - depth] if anchor[d] > 0 else row[depth:deeper]] = True
            new = np.flatnonzero(part & ~seen) if dims.size else np.arange(self.size)
            seen[new] = True
            depth = deeper
            # Random access to the rows met for the first time.
            scored, ids = self.scores(new, anchor), self.ids[new]
            worst = []
            for n, (least, most) in enumerate(windows):
                fits = (scored >= least) & (scored <= most) & (ids != own)
                score, some = np.r_[found[n][0], scored[fits]], np.r_[found[n][1], ids[fits]]
                best = np.lexsort((some, -score))[:wanted]
                found[n] = score[best], some[best]
                worst.append(int(score[best[-1]]) if len(best) == wanted else least)
            if depth >= self.size or self.threshold(depth, dims, anchor) < min(worst):
                return [(n, i, s) for n, (a, b) in enumerate(found) for s, i in zip(a.tolist(), b.tolist())]


def quantised(vectors: DataFrame, scale: int, key: str, vector: str, label: str) -> DataFrame:
    """Rows that take part: ``vec_id``, ``label``, and ``q``, the components times ``scale`` rounded down.

    Rows with a null id, label or vector, or with a component that is null or not
    finite, do not.  Rows that agree in all three count once.
    """
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    # Components that no long can hold are held at its ends, well before products are.
    limit = float(1 << 61)

    def held(x: Column) -> Column:
        return F.greatest(F.least(F.floor(F.lit(float(scale)) * x).cast("double"), F.lit(limit)), F.lit(-limit)).cast("long")

    return kept.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.transform(v, held).alias("q")
    ).distinct()


def build_shards(rows: DataFrame, size: int) -> DataFrame:
    """One row per shard: ``width``, ``label``, ``shard``, ids, vectors and sorted places.

    A shard has rows of one width and one label, dealt by a hash of the id; a label that
    most rows have has many shards.
    """
    counts = rows.groupBy(F.size("q").alias("width"), "label").agg(F.ceil(F.count("*") / size).cast("int").alias("shards"))
    dealt = rows.withColumn("width", F.size("q")).join(counts, ["width", "label"])
    dealt = dealt.select("width", "label", F.pmod(F.xxhash64("vec_id"), "shards").cast("int").alias("shard"), "vec_id", "q")
    schema = pa.schema(
        [("width", pa.int32()), ("label", pa.int64()), ("shard", pa.int32()), ("ids", pa.binary()),
         ("vectors", pa.binary()), ("sorted", pa.binary())]
    )

    def build(table: pa.Table) -> pa.Table:
        width, label, shard = (table.column(c)[0].as_py() for c in ("width", "label", "shard"))
        ids = table.column("vec_id").to_numpy()
        flat = table.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vectors = flat.reshape(len(ids), width)
        order = Lists.sorted_places(vectors)
        made = batch(schema, [width], [label], [shard], [ids.tobytes()], [vectors.tobytes()], [order.tobytes()])
        return pa.Table.from_batches([made])

    return dealt.groupBy("width", "label", "shard").applyInArrow(
        build, "width int, label long, shard int, ids binary, vectors binary, sorted binary"
    )


def _blocks(anchors: DataFrame, size: int) -> DataFrame:
    """Anchors of one width and label in blocks: ``width``, ``label``, ``block``, ``inside``."""
    own = anchors.select(F.size("q").alias("width"), "label", "vec_id", "q", "windows")
    sizes = own.groupBy("width", "label").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    dealt = own.join(sizes, ["width", "label"])
    block = F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block")
    return dealt.groupBy("width", "label", block).agg(F.collect_list(F.struct("vec_id", "q", "windows")).alias("inside"))


def _searched(blocks: DataFrame, shards: DataFrame, same_label: bool, wanted: int, step: int) -> DataFrame:
    """Rows found by every shard for every window: ``anchor_id``, ``window``, ``found_id``, ``found_score``."""
    names = shards.select("width", F.col("label").alias("there"), "shard")
    own = F.col("label") == F.col("there")
    sent = blocks.join(names, "width").where(own if same_label else ~own)
    index = shards.withColumnRenamed("label", "there")
    work = sent.select("width", "there", "shard", "label", "block", "inside").join(index, ["width", "there", "shard"])
    schema = pa.schema(
        [("anchor_id", pa.int64()), ("window", pa.int32()), ("found_id", pa.int64()), ("found_score", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at in range(part.num_rows):
                width, ids, vectors, order = (part.column(c)[at].as_py() for c in ("width", "ids", "vectors", "sorted"))
                ids = np.frombuffer(ids, np.int64)
                lists = Lists(
                    ids, np.frombuffer(vectors, np.int64).reshape(len(ids), width),
                    np.frombuffer(order, np.int32).reshape(width, len(ids)),
                )
                out: list[tuple[int, int, int, int]] = []
                for row in part.column("inside")[at].values:
                    anchor = np.asarray(row["q"].values.to_numpy(), np.int64)
                    windows = [(w["least"].as_py(), w["most"].as_py()) for w in row["windows"]]
                    own = row["vec_id"].as_py()
                    out += [(own, *x) for x in lists.search(anchor, own, windows, wanted, step)]
                if out:
                    yield batch(schema, *map(list, zip(*out)))

    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = work.repartition(parts, "width", "there", "shard", "label", "block")
    return mapped(dealt, run, "anchor_id long, window int, found_id long, found_score long")


def _first(found: DataFrame, wanted: int) -> DataFrame:
    """The first ``wanted`` rows of every window of every anchor, with ``rank`` from 1."""
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("found_score"), "found_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= wanted)


def mine(
    vectors: DataFrame,
    anchors: Column | str,
    settings: Settings = Settings(),
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """The hard negatives of every anchor and positive.

    Columns: ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``.  ``anchors`` is a condition over ``vec_id``.
    A row's score is its integer inner product with the anchor; higher ones come first,
    then smaller ids.  Positives are the first rows of the anchor's label, the anchor's id
    left out; negatives are the first rows of other labels inside the window.  An anchor
    without positives, and a positive without negatives, give no rows.

    Rows with a null id, label or vector, or a component null or not finite, take no
    part; vectors of other widths are never compared; rows equal in id, label and vector
    count once; an id that stands for several rows is an anchor once, as the least
    of them by label and vector; other columns are left out.  Scores beyond 2^62 are held there.
    """
    s = settings
    rows = staged(quantised(vectors, s.scale, key, vector, label), "quantised")
    shards = staged(build_shards(rows, s.shard), "sorted-lists")
    chosen = rows.where(F.expr(anchors) if isinstance(anchors, str) else anchors)
    chosen = chosen.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("row")).select("vec_id", "row.*")
    every = F.array(F.struct(F.lit(-MOST).alias("least"), F.lit(MOST).alias("most")))
    asked = _blocks(chosen.withColumn("windows", every), s.anchors)
    near = _first(_searched(asked, shards, True, s.positives, s.step), s.positives)
    positives = staged(
        near.select("anchor_id", F.col("rank").alias("nth"), F.col("found_id").alias("positive_id"),
                    F.col("found_score").alias("positive_score")), "positives"
    )
    # Bounds as whole numbers, in decimals, since products with large scores leave a long.
    wide = F.col("positive_score").cast("decimal(20,0)")
    least = F.ceil(wide * s.low / F.lit(100)).cast("long")
    most = F.floor(wide * s.high / F.lit(100)).cast("long")
    windows = positives.withColumns({"least": least, "most": most}).where("least <= most")
    listed = windows.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("nth", "least", "most"))).alias("windows"))
    again = chosen.join(listed, chosen["vec_id"] == listed["anchor_id"]).select("vec_id", "label", "q", "windows")
    far = _searched(_blocks(again, s.anchors), shards, False, s.negatives, s.step)
    # A search numbers its windows from 0; the lists say which positive each belongs to.
    places = listed.select("anchor_id", F.posexplode("windows").alias("window", "one")).select("anchor_id", "window", "one.nth")
    named = places.join(positives, ["anchor_id", "nth"]).select("anchor_id", "window", "positive_id", "positive_score")
    return _first(far, s.negatives).join(named, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
        F.col("found_score").alias("negative_score"),
    )
