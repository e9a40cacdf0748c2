"""Restartable loads: only what is not stored yet is worked on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cues
from .keyed import absent_rows, merge_by_key


def new_videos(listed: DataFrame, stored: DataFrame) -> DataFrame:
    """Listed videos whose URL is not stored."""
    return absent_rows(listed, stored, ["video_url"])


def describe_videos(
    enriched: DataFrame, scraped_at: str, words: Sequence[str] = cues.KEYWORDS
) -> DataFrame:
    """Add keywords, their flag and the time of the run."""
    return (
        enriched.withColumn(
            "matched_keywords", cues.matched_keywords(F.col("title"), F.col("description"), words)
        )
        .withColumn("is_related", F.size("matched_keywords") > 0)
        .withColumn("scraped_at", F.lit(scraped_at))
    )


def merge_videos(stored: DataFrame, described: DataFrame) -> DataFrame:
    """All videos by URL, new rows replacing old ones."""
    return merge_by_key(stored, described, ["video_url"], ["scraped_at"])


def unvisited(posts: DataFrame, visited: DataFrame) -> DataFrame:
    """Posts not visited in an earlier run, each URL once."""
    return absent_rows(posts.dropDuplicates(["url"]), visited, ["url"])


def visited_after(visited: DataFrame, posts: DataFrame) -> DataFrame:
    """State after a run: every post seen counts, also those that failed."""
    return visited.select("url").union(posts.select("url")).distinct()
