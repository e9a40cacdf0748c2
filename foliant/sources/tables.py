"""Pruned reads of stored tables and lookups in them.

Filters and column lists go straight to the scan; there is no paging.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = (),
    where: Column | None = None,
    schema: str | None = None,
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(path)
    if where is not None:
        table = table.where(where)
    return table.select(*columns) if columns else table


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt anew by a hash of the key, ahead of work that costs far more than moving them.

    A scan of few files has few tasks, however costly its texts are.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def by_key(df: DataFrame, key: str, value) -> DataFrame:
    """The row with the given key."""
    return df.where(F.col(key) == value).limit(1)


def only_row(df: DataFrame, key: str, value):
    """The one row with the given key; an error when there is none or more than one."""
    rows = df.where(F.col(key) == value).limit(2).collect()
    if len(rows) != 1:
        raise LookupError(f"{key} = {value!r}: expected one row, found {len(rows)}")
    return rows[0]


def by_keys(df: DataFrame, key: str, values: DataFrame | Sequence) -> DataFrame:
    """Rows whose key is listed; a table of keys becomes a semi join."""
    if isinstance(values, DataFrame):
        return df.join(values.select(key).distinct(), key, "left_semi")
    return df.where(F.col(key).isin(*values))


def page(df: DataFrame, order: Sequence[str], offset: int, size: int) -> DataFrame:
    """One page of an ordered table; needs a unique order to be stable."""
    return df.orderBy(*order).offset(offset).limit(size)


def category_by_folder(categories: DataFrame, folder: str) -> DataFrame:
    digits = folder.partition("_")[0]
    return by_key(categories, "id", int(digits) if digits.isdigit() and "_" in folder else None)
