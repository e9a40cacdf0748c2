"""Batches of documents in length buckets with the least padding."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Plan:
    """Tokens of the longest piece, number of buckets, tokens of a batch with its padding."""

    max_length: int = 4096
    buckets: int = 16
    budget: int = 65536

    def __post_init__(self):
        if not 0 < self.max_length <= self.budget or self.buckets < 1:
            raise ValueError("a batch must hold the longest piece, and there must be a bucket")


def optimal_limits(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Upper limits of at most ``buckets`` buckets with the least padding in all.

    ``lengths`` are distinct and ascending.  One bucket more is allowed per round;
    the best place for the last limit moves only upwards with its end, which halves
    the search again and again.  Among equal solutions the lowest limits win.
    """
    if not len(lengths):
        return []
    size = np.asarray(lengths, np.int64)
    below = np.r_[0, np.cumsum(np.asarray(counts, np.int64))]
    n, never = size.size, np.iinfo(np.int64).max // 2
    cost = np.full(n + 1, never)
    cost[0] = 0
    choices = []
    for _ in range(min(buckets, n)):
        best, choice = np.full(n + 1, never), np.zeros(n + 1, np.int64)
        best[0] = 0
        todo = [(1, n, 0, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            end = (low + high) // 2
            start = np.arange(first, min(last, end - 1) + 1)
            total = cost[start] + size[end - 1] * (below[end] - below[start])
            at = int(np.argmin(total))
            best[end], choice[end] = total[at], start[at]
            todo += [(low, end - 1, first, int(start[at])), (end + 1, high, int(start[at]), last)]
        choices.append(choice)
        cost = best
    limits, end = [], n
    for choice in reversed(choices):
        if end:
            limits.append(int(size[end - 1]))
            end = int(choice[end])
    return limits[::-1]


def pieces(lengths: DataFrame, max_length: int, key: str = "doc_id", tokens: str = "n_tokens") -> DataFrame:
    """Consecutive pieces of at most ``max_length`` tokens: ``doc_id``, ``piece``, ``start``, ``length``.

    A document without tokens is one piece of length 0; a null length counts as 0.
    """
    n = F.greatest(F.coalesce(F.col(tokens).cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long"))
    last = F.greatest(F.floor((n - 1) / max_length), F.lit(0).cast("long"))
    cut = lengths.select(
        F.col(key).alias("doc_id"), n.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")
    )
    start = F.col("piece") * max_length
    return cut.select(
        "doc_id", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(max_length)).alias("length")
    )


def pack(lengths: DataFrame, plan: Plan = Plan(), key: str = "doc_id", tokens: str = "n_tokens") -> DataFrame:
    """Every piece with its ``bucket``, ``padded`` length, ``batch`` in the bucket and ``slot`` in the batch.

    The histogram that reaches the driver has at most ``max_length + 1`` rows,
    whatever the input.  Inside a bucket pieces are dealt to parts by a hash,
    numbered in each part by (id, piece), and moved up by the sizes of the parts
    before: batches are full except the last one of a bucket, and a bucket that
    holds most rows still spreads over all parts.  Other columns are left out;
    repeated rows are packed each; an empty table gives no rows.
    """
    cut = pieces(lengths, plan.max_length, key, tokens)
    histogram = cut.groupBy("length").agg(F.count("*").alias("rows")).orderBy("length").collect()
    limits = optimal_limits([r["length"] for r in histogram], [r["rows"] for r in histogram], plan.buckets)
    places = F.array(*[F.lit(x).cast("long") for x in limits or [0]])
    parts = int(lengths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.lit(0)
    for limit in limits[:-1]:
        bucket = bucket + (F.col("length") > limit).cast("int")
    dealt = cut.withColumn("bucket", bucket).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int")
    )
    inside = Window.partitionBy("bucket", "part").orderBy(F.col("doc_id").asc_nulls_first(), "piece", "length")
    earlier = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("bucket", "part").agg(F.count("*").alias("rows"))
    before = sizes.select("bucket", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    numbered = dealt.withColumn("own", F.row_number().over(inside)).join(before, ["bucket", "part"])
    nth = F.col("own") + F.col("before") - 1
    padded = F.get(places, F.col("bucket"))
    room = F.floor(F.lit(plan.budget) / F.greatest(padded, F.lit(1).cast("long")))
    return numbered.select(
        "doc_id", "piece", "start", "length", "bucket", padded.alias("padded"),
        F.floor(nth / room).alias("batch"), F.pmod(nth, room).cast("int").alias("slot"),
    )
