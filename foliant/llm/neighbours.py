"""Nearest neighbours with a navigable small-world graph per shard.

A graph has layers; every layer holds about one in ``2 ** 4`` of the vectors of the
layer below, and every vector is linked to near ones of its layer.  A search
walks down from the top.  Graphs are plain arrays of neighbour places, built and
searched for many vectors at once, so each step is one array operation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, mapped, staged


@dataclass(frozen=True)
class Settings:
    """Links per vector, breadth of the search while building and while searching, vectors per shard.

    ``thinning`` is the ratio of two layers' sizes, ``queries`` the number of
    queries that travel together to every shard.
    """

    links: int = 16
    build_breadth: int = 64
    search_breadth: int = 96
    shard: int = 8192
    thinning: int = 16
    queries: int = 2048


class Graph:
    """Vectors, and for every layer the members' neighbours as places in the vectors (-1: none)."""

    def __init__(self, vectors: np.ndarray, settings: Settings):
        self.vectors, self.settings = vectors, settings
        self.square = np.einsum("ij,ij->i", vectors, vectors)
        self.layers: list[np.ndarray] = []
        self.depth = 0

    @classmethod
    def build(cls, vectors: np.ndarray, settings: Settings) -> Graph:
        """Vectors are added in their order in growing groups; a group is linked to the ones before it.

        The order must be random; a vector's place decides its layers, place 0
        being the entry, in all of them.
        """
        graph = cls(vectors, settings)
        n = len(vectors)
        sizes = [n]
        while sizes[-1] > settings.thinning * 2:
            sizes.append(-(-sizes[-1] // settings.thinning))
        for level, size in enumerate(sizes):
            width = settings.links * (2 if level == 0 else 1)
            graph.layers.append(np.full((size, width), -1, np.int32))
        done = min(n, settings.links + 1)
        graph.join(np.arange(done), np.arange(done), done)
        while done < n:
            group = np.arange(done, min(n, done + max(8, min(done // 2, 512))))
            graph.join(group, None, done)
            done = int(group[-1]) + 1
        return graph

    def join(self, group: np.ndarray, among: np.ndarray | None, done: int) -> None:
        """Links a group to what is there already, on every layer it reaches."""
        found = None
        for level in range(len(self.layers) - 1, -1, -1):
            size = min(done, len(self.layers[level]))
            reach = group[group < len(self.layers[level])]
            if among is not None:
                near = np.broadcast_to(among[among < size], (reach.size, (among < size).sum()))
            else:
                start = np.zeros((group.size, 1), np.int64) if found is None else found[:, :1]
                found = self.walk(self.vectors[group], level, start, self.settings.build_breadth, size)
                near = found[group < len(self.layers[level])]
            if reach.size:
                self.connect(level, reach, self.apart(reach, near))

    def apart(self, rows: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Neighbours for each row: a near one is skipped when it is nearer to one taken before.

        This keeps links in all directions; skipped ones fill what is left over.
        """
        most = self.settings.links
        distance = self.distances(self.vectors[rows], near)
        distance[(near == rows[:, None]) | (near < 0)] = np.inf
        order = np.argsort(distance, axis=1, kind="stable")
        near, distance = np.take_along_axis(near, order, 1), np.take_along_axis(distance, order, 1)
        near = np.where(np.isfinite(distance), near, -1)
        vectors = self.vectors[near]
        between = np.maximum(
            self.square[near][:, :, None] + self.square[near][:, None, :]
            - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1)), 0,
        )
        taken = np.zeros(near.shape, bool)
        for k in range(near.shape[1]):
            hidden = (taken[:, :k] & (between[:, k, :k] < distance[:, k, None])).any(axis=1)
            taken[:, k] = ~hidden & (near[:, k] >= 0) & (taken[:, :k].sum(axis=1) < most)
        rank = np.where(near < 0, 2, np.where(taken, 0, 1)) * near.shape[1] + np.arange(near.shape[1])
        first = np.argsort(rank, axis=1)[:, :most]
        return np.take_along_axis(near, first, 1)

    def connect(self, level: int, rows: np.ndarray, near: np.ndarray) -> None:
        """Sets the rows' links and adds the links back; a full row keeps its best."""
        table = self.layers[level]
        table[rows, : near.shape[1]] = near
        source, target = np.repeat(rows, near.shape[1]), near.ravel()
        kept = target >= 0
        source, target = source[kept], target[kept]
        missing = ~(table[target] == source[:, None]).any(axis=1)
        source, target = source[missing], target[missing]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        changed, start, count = np.unique(target, return_index=True, return_counts=True)
        old = table[changed]
        have = (old >= 0).sum(axis=1)
        room = have + count <= table.shape[1]
        nth = np.arange(target.size) - np.repeat(start, count)
        easy = np.repeat(room, count)
        table[target[easy], (np.repeat(have, count) + nth)[easy]] = source[easy]
        for row, first, n in zip(changed[~room], start[~room], count[~room]):
            every = np.unique(np.r_[table[row][table[row] >= 0], source[first : first + n]])
            best = self.apart(np.array([row]), every[None, :].astype(np.int64))[0]
            best = best[best >= 0]
            rest = every[~np.isin(every, best)]
            gap = table.shape[1] - best.size
            if gap > 0 and rest.size:
                far = self.distances(self.vectors[[row]], rest[None, :])[0]
                best = np.r_[best, rest[np.argsort(far, kind="stable")[:gap]]]
            table[row] = -1
            table[row, : best.size] = best[: table.shape[1]]

    def distances(self, queries: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Squared distances of every query to its own list of places."""
        found = np.einsum("ij,ikj->ik", queries, self.vectors[places])
        own = np.einsum("ij,ij->i", queries, queries)
        return np.maximum(own[:, None] + self.square[places] - 2 * found, 0)

    def walk(self, queries: np.ndarray, level: int, start: np.ndarray, breadth: int, size: int) -> np.ndarray:
        """Places of the nearest found, nearest first (-1: none), in one layer.

        All queries step together: each opens its nearest place that is not open
        yet, until none of its ``breadth`` best ones is left to open.
        """
        table = self.layers[level]
        n = len(queries)
        seen = np.zeros((n, size), bool)
        line = np.arange(n)[:, None]
        best = np.full((n, breadth), -1, np.int64)
        far = np.full((n, breadth), np.inf, np.float32)
        opened = np.ones((n, breadth), bool)
        width = start.shape[1]
        best[:, :width], opened[:, :width] = start, start < 0
        far[:, :width] = np.where(start < 0, np.inf, self.distances(queries, start))
        seen[line, np.maximum(start, 0)] = True
        alive = np.arange(n)
        while alive.size:
            nearest = np.argmin(np.where(opened[alive], np.inf, far[alive]), axis=1)
            going = ~opened[alive, nearest]
            alive, nearest = alive[going], nearest[going]
            if not alive.size:
                break
            opened[alive, nearest] = True
            near = table[best[alive, nearest]].astype(np.int64)
            rows = alive[:, None]
            known = (near < 0) | (near >= size)
            known |= seen[rows, np.where(known, 0, near)]
            seen[np.broadcast_to(rows, near.shape)[~known], near[~known]] = True
            distance = self.distances(queries[alive], np.maximum(near, 0)).astype(np.float32)
            distance[known] = np.inf
            every_far = np.hstack([far[alive], distance])
            every = np.hstack([best[alive], np.where(known, -1, near)])
            every_opened = np.hstack([opened[alive], known])
            kept = np.argpartition(every_far, breadth - 1, axis=1)[:, :breadth]
            far[alive] = np.take_along_axis(every_far, kept, 1)
            best[alive] = np.take_along_axis(every, kept, 1)
            opened[alive] = np.take_along_axis(every_opened, kept, 1)
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(best, order, 1)

    def search(self, queries: np.ndarray, breadth: int) -> np.ndarray:
        start = np.zeros((len(queries), 1), np.int64)
        for level in range(len(self.layers) - 1, 0, -1):
            found = self.walk(queries, level, start, 8, len(self.layers[level]))
            start = found[:, :1]
        return self.walk(queries, 0, start, max(1, min(breadth, len(self.vectors))), len(self.vectors))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id`` and ``v`` of rows with an id and a finite vector that is neither null nor zero."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), v.alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(finite & F.exists("v", lambda x: x != 0))


def build_index(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per shard: ``width`` of its vectors, ``shard``, vectors, graph, and ids of each vector.

    Equal vectors are indexed once, with their ``copies`` smallest ids (see
    ``search``).  Vectors of different widths never share a shard.  Shards are
    dealt by a hash of the vector and hold about ``settings.shard`` of them.
    """
    counts = vectors.groupBy(F.size("v").alias("width")).agg(
        F.ceil(F.count("*") / settings.shard).cast("int").alias("shards")
    )
    dealt = vectors.withColumn("width", F.size("v")).join(F.broadcast(counts), "width")
    dealt = dealt.select(
        "width", F.pmod(F.xxhash64("v"), F.col("shards")).cast("int").alias("shard"), "v", "ids"
    )
    schema = pa.schema(
        [("width", pa.int32()), ("shard", pa.int32()), ("vectors", pa.binary()), ("layers", pa.list_(pa.binary())),
         ("widths", pa.list_(pa.int32())), ("ids", pa.list_(pa.list_(pa.int64())))]
    )

    def build(table: pa.Table) -> pa.Table:
        width, shard = table.column("width")[0].as_py(), table.column("shard")[0].as_py()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        values = flat.reshape(-1, width)
        order = np.random.default_rng(shard).permutation(np.lexsort(values.T))
        values = values[order]
        graph = Graph.build(values.astype(np.float32), settings)
        ids = table.column("ids").take(pa.array(order)).combine_chunks()
        made = batch(
            schema, [width], [shard], [values.tobytes()], [[x.tobytes() for x in graph.layers]],
            [[x.shape[1] for x in graph.layers]], [ids.to_pylist()],
        )
        return pa.Table.from_batches([made])

    return dealt.groupBy("width", "shard").applyInArrow(
        build,
        "width int, shard int, vectors binary, layers array<binary>, widths array<int>, ids array<array<long>>",
    )


def search(
    vectors: DataFrame,
    queries: DataFrame,
    nearest: int = 10,
    settings: Settings = Settings(),
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``nearest`` rows found for every query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    ``score`` is the Euclidean distance of the original vectors in double
    precision; equal scores go to the smaller id, and a query is no candidate of
    its own.  Rows with a null id and vectors that are null, zero or hold anything
    not finite take no part, on either side; vectors of another width are never
    compared.  Every vector is indexed; queries go to all shards of their width in
    blocks, and the shards' results are merged.  A repeated id in the queries is
    answered once, with its least vector.
    """
    rows = usable(vectors, key, vector)
    asked = usable(queries, key, vector).groupBy("vec_id").agg(F.min("v").alias("v"))
    # Of many equal vectors no more than the nearest ids, and one for the query itself, can
    # be shown; the limit is applied before and after the shuffle, so a hot vector is no large group.
    same = Window.partitionBy("v").orderBy("vec_id")
    shown = rows.dropDuplicates(["vec_id", "v"]).withColumn("nth", F.row_number().over(same))
    distinct = shown.where(F.col("nth") <= nearest + 1).groupBy("v").agg(F.collect_list("vec_id").alias("ids"))
    index = staged(build_index(staged(distinct, "vectors"), settings), "graphs")
    shards = index.select("width", "shard")
    blocks = asked.select(
        F.size("v").alias("width"), F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)).alias("mark"), "vec_id", "v"
    )
    sizes = asked.groupBy(F.size("v").alias("width")).agg(
        F.ceil(F.count("*") / settings.queries).cast("int").alias("blocks")
    )
    blocks = (
        blocks.join(F.broadcast(sizes), "width")
        .groupBy("width", F.pmod("mark", F.col("blocks")).alias("block"))
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    )
    sent = blocks.join(shards, "width").select("width", "shard", "block", "queries")
    work = sent.join(index, ["width", "shard"])
    schema = pa.schema(
        [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for row in part.to_pylist():
                width = row["width"]
                values = np.frombuffer(row["vectors"], np.float64).reshape(-1, width)
                graph = Graph(values.astype(np.float32), settings)
                graph.layers = [
                    np.frombuffer(x, np.int32).reshape(-1, w) for x, w in zip(row["layers"], row["widths"])
                ]
                for low in range(0, len(row["queries"]), 512):
                    some = row["queries"][low : low + 512]
                    points = np.array([q["v"] for q in some])
                    found = graph.search(points.astype(np.float32), max(settings.search_breadth, nearest + 1))
                    out: list[tuple[int, int, float]] = []
                    for query, point, places in zip(some, points, found):
                        places = places[places >= 0]
                        exact = np.sqrt(((values[places] - point) ** 2).sum(axis=1))
                        own = [
                            (float(score), i)
                            for score, place in zip(exact, places.tolist())
                            for i in row["ids"][place]
                            if i != query["vec_id"]
                        ]
                        own.sort()
                        out += [(query["vec_id"], i, score) for score, i in own[:nearest]]
                    if out:
                        yield batch(schema, *map(list, zip(*out)))

    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = mapped(work.repartition(parts, "width", "shard", "block"), ask, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )
