"""What a run would change, and rows that it refuses, found before anything is written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGES = ("new", "changed", "equal", "gone")


def classify(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key with its ``change``: new, changed, equal or gone.

    Keys are unique on both sides; null keys are keys.  Only keys and a hash of the
    other columns are shuffled, and counted before; a key is on one side, or on both with one
    hash or two.
    """
    others = [c for c in new.columns if c not in keys]

    def narrow(df: DataFrame, side: int) -> DataFrame:
        plain = F.xxhash64(*[F.to_json(F.struct(c)) if _is_map(new, c) else F.col(c) for c in others], F.lit(0))
        # Nulls do not change such a hash; where they stand is hashed as well.
        empty = F.xxhash64(*[F.col(c).isNull() for c in others], F.lit(0))
        return df.select(*keys, plain.alias("_hash"), empty.alias("_empty"), F.lit(side).alias("_side"))

    sides = narrow(old, 0).unionByName(narrow(new, 1)).groupBy(*keys).agg(
        F.min("_side").alias("_first"), F.max("_side").alias("_last"),
        ((F.min("_hash") == F.max("_hash")) & (F.min("_empty") == F.max("_empty"))).alias("_same"),
    )
    change = (
        F.when(F.col("_first") == 1, "new").when(F.col("_last") == 0, "gone").when(F.col("_same"), "equal").otherwise("changed")
    )
    return sides.select(*keys, change.alias("change"))


def _is_map(df: DataFrame, column: str) -> bool:
    return "map<" in df.schema[column].dataType.simpleString()


def counts(classified: DataFrame) -> DataFrame:
    """One row: the number of keys of every kind of change."""
    return classified.agg(*[F.count_if(F.col("change") == c).alias(c) for c in CHANGES])


def refused(rows: DataFrame, checks: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """The rows with ``step`` and ``reason`` of the first check that refuses them, null where none does.

    ``checks`` has for every step, in order, reasons with their conditions; a condition that
    is null does not refuse.  Conditions are evaluated with the rows, in the same pass; those
    that may fail are written with the try-functions.
    """
    found = F.lit(None).cast("struct<step:string,reason:string>")
    listed = [(step, reason, condition) for step, some in checks.items() for reason, condition in some.items()]
    for step, reason, condition in reversed(listed):
        here = F.struct(F.lit(step).alias("step"), F.lit(reason).alias("reason"))
        found = F.when(F.coalesce(condition, F.lit(False)), here).otherwise(found)
    return rows.withColumn("_refused", found).select(*rows.columns, "_refused.step", "_refused.reason")
