"""Markdown documents of downloaded articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html, names
from ..operators.keyed import absent_rows
from ..operators.ranking import numbered


def place(links: DataFrame, existing: int = 0) -> DataFrame:
    """Number the links of every folder, after the files it has, and name their files."""
    placed = numbered(links, ["folder"], ["position"], "number")
    return placed.withColumn("number", F.col("number") + existing).withColumn(
        "filename", names.numbered_filename(F.col("number"), names.safe_filename(F.col("title")))
    )


def place_posts(posts: DataFrame, existing: int = 0) -> DataFrame:
    """Number blog posts in crawl order after the stored files; nameless ones by number."""
    placed = numbered(posts, [], ["position"], "number")
    number = F.col("number") + existing
    slug = F.coalesce(
        F.nullif(names.slugify(F.col("title")), F.lit("")),
        F.concat(F.lit("article_"), number.cast("string")),
    )
    return placed.withColumn("filename", names.numbered_filename(number, slug)).withColumn(
        "number", number
    )


def missing_documents(placed: DataFrame, files: DataFrame) -> DataFrame:
    """Placed links whose file does not exist yet."""
    return absent_rows(placed, files.select("folder", "filename"), ["folder", "filename"])


def article_documents(fetched: DataFrame, known_hosts: Sequence[str]) -> DataFrame:
    """Text of every document: a note for external pages, else header and body.

    Needs ``folder``, ``title``, ``url``, ``page_title`` and ``markdown``; rows
    without markdown failed and stay out unless they are external.
    """
    shown = F.coalesce(F.nullif(F.col("page_title"), F.lit("")), F.col("title"))
    category = names.title_case(F.translate(F.col("folder"), "_", " "))
    document = html.assemble_document(shown, F.col("url"), category, F.col("markdown"))
    external = names.is_external(F.col("url"), known_hosts)
    return fetched.withColumn(
        "document",
        F.when(external, html.external_stub(F.col("title"), F.col("url"))).otherwise(document),
    ).where(F.col("document").isNotNull())


def write_documents(documents: DataFrame, root: str, put) -> None:
    """Write one file per document with ``put(path, text)``, run inside the tasks."""

    def run(rows) -> None:
        for row in rows:
            put(f"{root}/{row['folder']}/{row['filename']}", row["document"])

    documents.select("folder", "filename", "document").foreachPartition(run)
