"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """Columns ``node`` and ``root`` (smallest node of its component) from links ``a``, ``b``.

    Large-star and small-star steps alternate until nothing changes.  Minima are
    aggregated before the shuffle, and no neighbourhood is gathered, so a node
    with millions of links costs no task more memory.  Each round is written to
    the shared folder, in place of the last one.  Loops, repeated links and links with a null end have no
    effect; nodes without a link to another are not listed.
    """
    pairs = (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = staged(pairs, name)
    seen = _signature(state)
    while seen[0]:
        before, state = state, staged(_small_star(_large_star(state)), name)
        discard(before)
        now = _signature(state)
        if now == seen:
            break
        seen = now
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def hooks(links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root``, a smaller node of its component, from links ``a``, ``b``, in one step.

    The root is the smallest node at most two links away; nodes without a smaller one there are
    not listed.  Nodes with one root are connected; unlike with ``components``, a component may
    keep several roots.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = links.select(F.explode(ways).alias("way")).select("way.*")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    reached = both.join(least, "a").groupBy(F.col("b").alias("node")).agg(F.min("m").alias("root"))
    return reached.where("root < node")


def _signature(pairs: DataFrame) -> tuple:
    """Number of links and an order-free checksum, to see whether a round changed any."""
    mark = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(pairs.agg(F.count("*"), F.sum(mark)).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest one around it."""
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    moved = pairs.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where(F.col("a") != F.col("b")).unionAll(
        least.select("a", F.col("m").alias("b"))
    ).distinct()
