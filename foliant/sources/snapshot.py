"""A scan of markdown files that remembers: a second run parses only what has changed.

The rows of the files lie in a bucketed table by path, each with size and time of the
file they were read from.  A run lists the files, which reads none of them, and compares.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.buckets import BucketTable
from ..staging import staged
from .files import INDEX_FILES, decode_utf8, parts

SCHEMA = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("size", T.LongType()), T.StructField("modified", T.TimestampType())]
    + [T.StructField(name, T.StringType()) for name in ("path", "folder", "filename", "raw")]
)

# Changed files up to this number are opened by name; more are found by one scan over all.
OPENED_BY_NAME = 10_000


def _listed(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(f"{root}/*/*.md")
    found = files.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    return found.where(~F.element_at(F.split("file", "/"), -1).isin(*INDEX_FILES))


def differences(spark: SparkSession, root: str, held: BucketTable) -> DataFrame:
    """Files that are new, changed or gone, with ``change``; no file is opened."""
    known = held.read().select("file", "size", "modified")
    sides = known.withColumn("now", F.lit(0)).unionByName(_listed(spark, root).withColumn("now", F.lit(1)))
    judged = sides.groupBy("file").agg(
        F.min("now").alias("first"), F.max("now").alias("last"), F.count("*").alias("n"),
        F.count_distinct("size", "modified").alias("states"),
    )
    change = F.when(F.col("first") == 1, "new").when(F.col("last") == 0, "gone").when(F.col("states") > 1, "changed")
    return judged.select("file", change.alias("change")).where(F.col("change").isNotNull())


def refresh(spark: SparkSession, root: str, store: str, buckets: int = 64) -> DataFrame:
    """The article files below the root, as ``read_markdown`` gives them; unchanged ones come from the store.

    Rows of changed and gone files are replaced in their buckets, all others stay as they
    are written.  Without a change nothing is written.
    """
    held = BucketTable(spark, store, SCHEMA, ["file"], buckets)
    found = staged(differences(spark, root, held), "changed-files")
    if not found.isEmpty():
        due = found.where("change <> 'gone'").select("file")
        some = [r["file"] for r in due.limit(OPENED_BY_NAME + 1).collect()]
        source = spark.read.format("binaryFile")
        if some:
            opened = source.load(some) if len(some) <= OPENED_BY_NAME else source.load(f"{root}/*/*.md")
            rows = opened.withColumnsRenamed({"path": "file", "length": "size", "modificationTime": "modified"})
            named = parts(rows, F.col("file"), decode_utf8(F.col("content")), "file", "size", "modified")
            fresh = named.join(due, "file", "left_semi").select(*SCHEMA.names)
        else:
            fresh = spark.createDataFrame([], SCHEMA)
        held.replace_groups(fresh, found.select("file"))
    return held.read().select("path", "folder", "filename", "raw")

