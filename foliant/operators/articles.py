"""Article tables from files, and the reader's views of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blocks, header, names, text
from ..functions.once import of_name
from ..functions.patterns import WEB_SPACE
from . import changes
from .collisions import resolve_slugs


def parse_files(files: DataFrame) -> DataFrame:
    """Article rows of non-empty files, slugs not yet unique."""
    raw, name, folder = F.col("raw"), F.col("filename"), F.col("folder")
    parsed = (
        files.where(~text.is_blank(raw))
        .select(
            "path", "folder", "filename",
            names.category_id(folder).alias("category_id"),
            header.title(raw, name).alias("title"),
            header.category_name(raw).alias("category_name"),
            header.source_url(raw).alias("source_url"),
            header.body(raw).alias("content"),
        )
    )
    return parsed.withColumn("word_count", text.count_content_words(F.col("content"))).select(
        names.base_slug(name, F.col("category_id")).alias("slug"),
        "title",
        "category_id",
        "category_name",
        names.category_slug(folder).alias("category_slug"),
        "source_url",
        "content",
        of_name(blocks.render, "content").alias("content_html"),
        "word_count",
        F.col("path").alias("file_path"),
        names.article_order(name).alias("article_order"),
        text.is_stub(F.col("word_count")).alias("is_stub"),
    )


def build_articles(files: DataFrame) -> DataFrame:
    """Article rows with unique slugs.

    Slugs come from paths; of the texts only whether they are blank matters to
    them, which is found ahead.  The article table then reads each text once.
    """
    name = F.col("filename")
    keys = files.where(~text.is_blank(F.col("raw"))).select(
        names.base_slug(name, names.category_id(F.col("folder"))).alias("slug"),
        names.article_order(name).alias("article_order"),
        F.col("path").alias("file_path"),
    )
    return resolve_slugs(parse_files(files), keys=keys)


def file_checks() -> dict[str, dict[str, Column]]:
    """What refuses a file, by step: nothing in it, bytes that are no text, no category, nothing behind the header."""
    raw, folder = F.col("raw"), F.col("folder")
    return {
        "read": {"empty file": text.is_blank(raw), "bytes that are no text": F.contains(raw, F.lit("\ufffd"))},
        "category": {"no number in the folder": F.coalesce(names.category_id(folder), F.lit(0)) == 0},
        "body": {"nothing behind the header": text.is_blank(header.body(raw))},
    }


def rejects(files: DataFrame, checks: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """Path, step and reason of every file that is not parsed."""
    judged = changes.refused(files, checks or file_checks())
    return judged.where(F.col("step").isNotNull()).select("path", "step", "reason")


def accepted(files: DataFrame, checks: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """The files that no check refuses, as they came."""
    return changes.refused(files, checks or file_checks()).where(F.col("step").isNull()).select(*files.columns)


def run_counts(files: DataFrame, checks: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """Files found, parsed, skipped as empty, and failed, in one row; the last three add up to the first."""
    judged = changes.refused(files, checks or file_checks())
    empty = F.coalesce(F.col("reason") == "empty file", F.lit(False))
    return judged.agg(
        F.count("*").alias("found"), F.count_if(F.col("step").isNull()).alias("parsed"),
        F.count_if(empty).alias("skipped"), F.count_if(F.col("step").isNotNull() & ~empty).alias("failed"),
    )


def ingest_summary(files: DataFrame, articles: DataFrame) -> DataFrame:
    """Files found, articles parsed, empty files skipped and stubs, in one row."""
    counted = files.select(
        F.lit(1).alias("found"),
        text.is_blank(F.col("raw")).cast("int").alias("skipped"),
        F.lit(0).alias("stubs"),
    ).unionAll(articles.select(F.lit(0), F.lit(0), F.col("is_stub").cast("int")))
    return counted.agg(
        F.sum("found").alias("total_files"),
        (F.sum("found") - F.sum("skipped")).alias("parsed"),
        F.sum("skipped").alias("skipped_empty"),
        F.sum("stubs").alias("stubs"),
    )


def load_local(files: DataFrame, categories: DataFrame) -> DataFrame:
    """The reader's articles: known categories only, its own title and URL rules."""
    raw, name = F.col("raw"), F.col("filename")
    shown = (
        files.where(name.endswith(".md") & ~name.startswith("00_INDEX"))
        .where(name != "00_MASTER_INDEX.md")
        .withColumn("category_id", names.category_id(F.col("folder")))
        .join(
            categories.select(
                F.col("id").alias("category_id"),
                F.col("name").alias("category_name"),
                F.col("slug").alias("category_slug"),
            ),
            "category_id",
        )
        .withColumn(
            "base_slug", names.base_slug(name, F.col("category_id"), any_case_suffix=False)
        )
        .select(
            F.col("base_slug").alias("slug"),
            header.shown_title(raw, F.col("base_slug")).alias("title"),
            "category_id", "category_name", "category_slug",
            header.shown_source_url(raw).alias("source_url"),
            header.shown_body(raw).alias("content"),
            text.count_words(raw, WEB_SPACE).alias("word_count"),
            F.col("path").alias("file_path"),
            names.article_order(name).alias("article_order"),
        )
    )
    unique = resolve_slugs(shown)
    return unique.select(F.col("slug").alias("id"), *unique.columns)


SUMMARY = [
    "id", "slug", "title", "category_id", "category_name", "category_slug",
    "source_url", "word_count", "article_order",
]


def summaries(articles: DataFrame, category_id: int | None = None) -> DataFrame:
    """Articles without their body but with an excerpt, of one category or all."""
    kept = articles if category_id is None else articles.where(F.col("category_id") == category_id)
    return kept.select(*SUMMARY, text.excerpt(F.col("content")).alias("excerpt"))


def category_distribution(articles: DataFrame) -> DataFrame:
    return (
        articles.groupBy("category_id")
        .agg(F.min("category_name").alias("category_name"), F.count("*").alias("articles"))
        .orderBy("category_id")
    )
