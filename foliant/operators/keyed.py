"""Keyed tables: first and last row per key, merges and set differences.

Rows per key are chosen by aggregates, which combine before the shuffle, so a
key that holds a large share of all rows does not land whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], best: Column) -> DataFrame:
    return df.groupBy(*keys).agg(best.alias("_row")).select("_row.*")


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order."""
    return _pick(df, keys, F.min_by(_row(df), F.struct(*order)))


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in the given order."""
    return _pick(df, keys, F.max_by(_row(df), F.struct(*order)))


def merge_by_key(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Union in which a new row replaces the old one of the same key."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return last_per_key(both, keys, ["_new", *order]).drop("_new")


def absent_rows(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the left whose key is not on the right; NULL keys are equal."""
    seen = right.select(*[F.col(c).alias(f"_r_{c}") for c in on])
    same = F.lit(True)
    for c in on:
        same = same & left[c].eqNullSafe(seen[f"_r_{c}"])
    return left.join(seen, same, "left_anti")


def present_rows(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the left whose key is on the right."""
    return left.join(right.select(*on), list(on), "left_semi")


def insert_missing(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Rows to append: the first new row of every key the table does not hold."""
    return absent_rows(first_per_key(new, keys, order), old, keys)


def one_sided(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys found on one side only, with the side; one shuffle for both."""
    tagged = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).union(
        right.select(key, F.lit(0), F.lit(1))
    )
    sides = tagged.groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return sides.where(F.col("l") != F.col("r")).select(
        key, F.when(F.col("l") == 1, "left").otherwise("right").alias("side")
    )


def removed_per_group(
    df: DataFrame, group: str, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Rows, kept first occurrences and removed repeats of each group."""
    narrow = df.select(*dict.fromkeys([group, *keys, *order]))
    kept = first_per_key(narrow, keys, order).groupBy(group).agg(F.count("*").alias("kept"))
    total = df.groupBy(group).agg(F.count("*").alias("total"))
    return (
        total.join(kept, group, "left")
        .withColumn("kept", F.coalesce("kept", F.lit(0)))
        .withColumn("removed", F.col("total") - F.col("kept"))
    )
