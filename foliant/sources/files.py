"""Markdown files as rows, one per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Index files that are no articles.
INDEX_FILES = ("00_INDEX.md", "00_MASTER_INDEX.md")


def parts(df: DataFrame, path: Column, raw: Column, *more: str) -> DataFrame:
    """Folder, name and text of files by their paths, and further columns."""
    steps = F.split(path, "/")
    return df.select(
        *more,
        F.concat_ws("/", F.element_at(steps, -2), F.element_at(steps, -1)).alias("path"),
        F.element_at(steps, -2).alias("folder"),
        F.element_at(steps, -1).alias("filename"),
        raw.alias("raw"),
    )


def read_markdown(spark: SparkSession, root: str) -> DataFrame:
    """Article files below the root's folders, index files left out."""
    scan = (
        spark.read.format("binaryFile")
        .load(f"{root}/*/*.md")
        .select("path", "content")
    )
    files = parts(scan, F.col("path"), decode_utf8(F.col("content")))
    return files.where(~F.col("filename").isin(*INDEX_FILES))


def decode_utf8(content: Column) -> Column:
    """Bytes as text, with the replacement character for broken sequences."""
    return F.make_valid_utf8(content.cast("string"))


def count_files(spark: SparkSession, folder: str) -> int:
    """Markdown files in one folder, to continue its numbering."""
    scan = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(folder)
    return scan.select("path").count()
