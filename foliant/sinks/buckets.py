"""Tables in key buckets, of which a merge writes only those it touches.

A version is a list of buckets with the folder that holds each.  A write puts the rows
of its buckets into a folder of its own and then adds the next version, which takes all
other buckets over as they are.  Readers take the last version that is complete, so a
lost executor or a run that fails leaves the table as it was, and nothing is written over.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import changes, keyed
from ..staging import staged

_ENTRY = "version long, bucket int, path string, rows long"
_BUCKET = "_bucket"


@dataclass(frozen=True)
class BucketTable:
    """A table at ``root`` whose rows lie in ``buckets`` by a hash of the ``keys``.

    Nulls are keys too.  Version lists have one row per bucket; they are all that ever
    reaches the driver.  One writer at a time.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def entries(self) -> list:
        """The buckets of the current version; none before the first write."""
        try:
            every = self.spark.read.schema(_ENTRY).json(f"{self.root}/versions/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        last = every.agg(F.max("version")).first()[0]
        return every.where(F.col("version") == F.lit(last)).collect()

    def _rows(self, entries: Sequence) -> DataFrame:
        paths = [e["path"] for e in entries if e["path"]]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        return self._rows(self.entries())

    def _write(self, rows: DataFrame, entries: Sequence, touched: set[int]) -> None:
        """New contents of the touched buckets, then the version that names them."""
        version = max((e["version"] for e in entries), default=0) + 1
        folder = f"{self.root}/data/{version:08d}-{uuid.uuid4().hex}"
        # Rows of a bucket come together where they are few; a bucket that holds many is split.
        dealt = rows.withColumn(_BUCKET, self.bucket()).hint("rebalance", _BUCKET)
        dealt.write.partitionBy(_BUCKET).parquet(folder)
        stored = self.spark.read.schema(f"{_BUCKET} int").parquet(folder) if touched else None
        counts = {r[0]: r[1] for r in stored.groupBy(_BUCKET).count().collect()} if touched else {}
        kept = [(version, e["bucket"], e["path"], e["rows"]) for e in entries if e["bucket"] is not None and e["bucket"] not in touched]
        made = [(version, b, f"{folder}/{_BUCKET}={b}", n) for b, n in counts.items()]
        # A version without rows is a version too.
        listed = kept + made or [(version, None, None, 0)]
        self.spark.createDataFrame(listed, _ENTRY).coalesce(1).write.json(f"{self.root}/versions/{version:08d}")

    def _touched(self, rows: DataFrame) -> set[int]:
        return {r[0] for r in rows.select(self.bucket()).distinct().collect()}

    def merge(self, new: DataFrame, order: Sequence[str]) -> None:
        """New rows replace old ones with their key, of several the last in the given order."""
        new = staged(new.select(*self.schema.names), "merged-rows")
        entries, touched = self.entries(), self._touched(new)
        old = self._rows([e for e in entries if e["bucket"] in touched])
        self._write(keyed.merge_by_key(old, new, self.keys, order), entries, touched)

    def insert_missing(self, new: DataFrame, order: Sequence[str]) -> None:
        """Rows whose key is not there; running it again adds nothing and rewrites nothing."""
        new = staged(new.select(*self.schema.names), "missing-rows")
        entries, near = self.entries(), self._touched(new)
        old = self._rows([e for e in entries if e["bucket"] in near])
        more = staged(keyed.insert_missing(old, new, self.keys, order), "missing-rows")
        touched = self._touched(more)
        if touched:
            self._write(self._rows([e for e in entries if e["bucket"] in touched]).unionByName(more), entries, touched)

    def replace_groups(self, rows: DataFrame, groups: DataFrame) -> None:
        """All rows of the given keys are replaced by the new ones; a key without new rows loses its old ones.

        ``groups`` has the key columns.  Rows of keys that it does not list are written too,
        and replace the old ones of theirs.
        """
        rows = staged(rows.select(*self.schema.names), "group-rows")
        listed = groups.select(*self.keys).unionByName(rows.select(*self.keys)).distinct()
        entries, touched = self.entries(), self._touched(listed)
        old = self._rows([e for e in entries if e["bucket"] in touched])
        self._write(keyed.absent_rows(old, listed, self.keys).unionByName(rows), entries, touched)

    def replace(self, rows: DataFrame) -> None:
        """A full run: all buckets anew, the old ones readable until the version is there."""
        entries = self.entries()
        self._write(rows.select(*self.schema.names), entries, set(range(self.buckets)))

    def dry_run(self, new: DataFrame, order: Sequence[str], whole: bool = False) -> DataFrame:
        """What ``merge`` (or, ``whole``, ``replace``) would do to every key; nothing is written.

        Only buckets that new rows fall into are read, unless the run is a whole one.
        """
        entries = self.entries()
        if not whole:
            touched = self._touched(new)
            entries = [e for e in entries if e["bucket"] in touched]
        found = changes.classify(self._rows(entries), keyed.last_per_key(new.select(*self.schema.names), self.keys, order), self.keys)
        return found if whole else found.where(F.col("change") != "gone")
