"""Video catalogues and details as typed rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cues

WATCH_PREFIX = "https://www.youtube.com/watch?v="

# Returns subtitle text for a URL, or None.
FetchText = Callable[[str], str | None]


def listed_videos(entries: DataFrame) -> DataFrame:
    """Catalogue rows; entries that are NULL as a whole are skipped."""
    known = F.coalesce("id", "url", "title").isNotNull()
    return entries.where(known).select(
        F.coalesce("title", F.lit("")).alias("title"),
        cues.watch_url(F.col("url"), F.col("id"), WATCH_PREFIX).alias("video_url"),
        F.coalesce("id", F.lit("")).alias("id"),
        "duration",
    )


def enrich_videos(info: DataFrame, fetch_text: FetchText) -> DataFrame:
    """Video rows with transcript from detail records that name their URL."""
    tracked = info.withColumn(
        "_track", cues.subtitle_url(F.col("subtitles"), F.col("automatic_captions"))
    ).select(
        F.coalesce("title", F.lit("")).alias("title"),
        F.col("video_url"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce("upload_date", F.lit("")).alias("upload_date"),
        "duration",
        F.coalesce("thumbnail", F.lit("")).alias("thumbnail_url"),
        "view_count",
        "_track",
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(cues=[_text(fetch_text, url) for url in batch["_track"]])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tracked.schema.fields)
    fetched = tracked.mapInPandas(run, f"{fields}, cues string")
    return (
        fetched.withColumn("transcript", F.coalesce(cues.clean_cues(F.col("cues")), F.lit("")))
        .withColumn("has_transcript", F.col("transcript") != "")
        .drop("_track", "cues")
    )


def _text(fetch_text: FetchText, url: str | None) -> str | None:
    if not url:
        return None
    try:
        return fetch_text(url)
    except Exception:
        return None
