"""Writes of merged tables.

A merged table is written beside the old one, never over the files it is read
from, so a lost executor or a failed run leaves the old table whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keyed


def _stored(spark: SparkSession, path: str | None, like: DataFrame) -> DataFrame:
    if path is None:
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).parquet(path)


def upsert(
    new: DataFrame, old_path: str | None, target: str, keys: Sequence[str], order: Sequence[str]
) -> None:
    """Write old and new rows, new ones replacing old ones with the same key."""
    old = _stored(new.sparkSession, old_path, new)
    keyed.merge_by_key(old, new, keys, order).write.mode("errorifexists").parquet(target)


def append_missing(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Append the rows whose key the table does not hold; running it again adds nothing."""
    old = new.sparkSession.read.schema(new.schema).parquet(path)
    keyed.insert_missing(old, new, keys, order).write.mode("append").parquet(path)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def replace(rows: DataFrame, target: str) -> None:
    """Write a table anew, such as the citation index of a full run, in a folder of its own.

    ``buckets.BucketTable.replace`` keeps the same root, with the old version readable meanwhile.
    """
    rows.write.mode("errorifexists").parquet(target)


def replace_children(
    rows: DataFrame, old_path: str, target: str, parent: str = "article_id", parents: DataFrame | None = None
) -> None:
    """Write the old rows of all other parents together with the new rows.

    ``parents`` has the column ``parent`` of all that were looked at; one of them without new
    rows has none any more.  Parents of new rows need not be listed.
    """
    old = rows.sparkSession.read.schema(rows.schema).parquet(old_path)
    seen = rows.select(parent) if parents is None else rows.select(parent).unionByName(parents.select(parent))
    kept = keyed.absent_rows(old, seen.distinct(), [parent])
    kept.unionByName(rows).write.mode("errorifexists").parquet(target)


def write_index(junction: DataFrame, verses_of, root: str) -> None:
    """Junction first, then the verse table read back from it: texts are read once.  The root is new in every run."""
    junction.write.mode("errorifexists").parquet(f"{root}/junction")
    stored = junction.sparkSession.read.schema(junction.schema).parquet(f"{root}/junction")
    verses_of(stored).write.mode("errorifexists").parquet(f"{root}/verses")


def in_batches(df: DataFrame, send, size: int) -> None:
    """Hand the rows of every partition to ``send`` in lists of a fixed size."""

    def run(rows) -> None:
        batch = []
        for row in rows:
            batch.append(row.asDict(recursive=True))
            if len(batch) == size:
                send(batch)
                batch = []
        if batch:
            send(batch)

    df.foreachPartition(run)
