"""Positions inside ordered groups, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import staged


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    parts: int | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add the 1-based position of each row in its group, in the given order.

    A window over a key puts a whole group into one task, and one over no key the
    whole table.  So rows are dealt to ranges of (keys, order) and written to the
    shared folder, which fixes the ranges; rows are numbered inside their range,
    and the rows that the same group has in earlier ranges are added.  At most one
    group per range goes on from an earlier one, so the table of offsets has at
    most ``parts`` rows and is safe to broadcast.  Ties in the order are dealt and
    numbered by a hash of the whole row; only rows equal in every column stay
    together.
    """
    keys, order = list(keys), list(order)
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = [_quoted(c.name) for c in df.schema if not isinstance(c.dataType, T.MapType)]
    sides = [F.desc(_quoted(c)) if descending else F.asc(_quoted(c)) for c in order]
    sorts = [*[F.asc(_quoted(k)) for k in keys], *sides, F.asc("_tie")]
    ranged = df.withColumn("_tie", F.xxhash64(*plain)).repartitionByRange(parts, *sorts)
    ranged = ranged.sortWithinPartitions(*sorts).select(
        *[_quoted(c) for c in df.columns],
        F.spark_partition_id().alias("_range"),
        F.monotonically_increasing_id().alias("_at"),
    )
    fixed = staged(ranged, "ranges")
    named = [F.col(_quoted(k)).alias(f"_key_{i}") for i, k in enumerate(keys)]
    keyed = [f"_key_{i}" for i in range(len(keys))]
    per_range = fixed.select("_range", *named).groupBy("_range", *keyed).agg(F.count("*").alias("_rows"))
    spans = Window.partitionBy(*keyed) if keys else Window.partitionBy(F.lit(0))
    before = spans.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.withColumn("_before", F.sum("_rows").over(before)).where(F.col("_before") > 0)
    offsets = offsets.withColumnRenamed("_range", "_there").drop("_rows")
    inside = Window.partitionBy("_range", *[_quoted(k) for k in keys]).orderBy("_at")
    local = fixed.withColumn("_local", F.row_number().over(inside).cast("bigint"))
    same = local["_range"] == offsets["_there"]
    for key, other in zip(keys, keyed):
        same = same & local[_quoted(key)].eqNullSafe(offsets[other])
    place = F.col("_local") + F.coalesce(F.col("_before"), F.lit(0))
    joined = local.join(F.broadcast(offsets), same, "left")
    return joined.select(*[_quoted(c) for c in df.columns if c != name], place.alias(name))


def _quoted(column: str) -> str:
    """The name as it can stand in an expression, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def batches(df: DataFrame, order: Sequence[str], size: int, name: str = "batch", parts: int | None = None) -> DataFrame:
    """Number fixed-size batches of the whole table in the given order, from 0."""
    placed = numbered(df, [], order, "_position", parts)
    return placed.withColumn(name, F.floor((F.col("_position") - 1) / size)).drop("_position")
