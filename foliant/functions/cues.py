"""Video text: subtitle tracks, subtitle cleaning and keywords."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import WORD
from .text import strip_space

# Topic words, subtitle formats and the line starts to skip.
KEYWORDS = (
    "islam", "muslim", "quran", "muhammad", "allah", "hadith", "mosque",
    "sharia", "jihad", "kafir", "haram", "halal", "surah", "ayah", "ummah",
    "dawah", "fatwa", "imam", "mufti", "sheikh", "burqa", "hijab", "ramadan",
    "eid", "dua", "jinn", "sunnah", "salah", "wudu", "zakat",
)
SUBTITLE_FORMATS = ("vtt", "srv1", "json3")
SKIPPED_CUE_LINE = r"^(?:WEBVTT|Kind:|Language:|\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2}|\p{Nd}+\z)"


def matched_keywords(title: Column, description: Column, words: Sequence[str] = KEYWORDS) -> Column:
    """Distinct topic words of title and description, sorted."""
    text = F.lower(F.concat_ws(" ", title, F.coalesce(description, F.lit(""))))
    pattern = rf"(?<![{WORD}])({'|'.join(words)})(?![{WORD}])"
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))))


def clean_cues(cues: Column) -> Column:
    """Spoken text of a WebVTT file: each line once, in first-seen order."""
    lines = F.transform(F.split(cues, "\n"), lambda line: strip_space(line))
    spoken = F.filter(lines, lambda line: ~line.rlike(SKIPPED_CUE_LINE))
    plain = F.transform(spoken, lambda line: strip_space(F.regexp_replace(line, "<[^>]+>", "")))
    return F.array_join(F.array_distinct(F.filter(plain, lambda line: line != "")), " ")


def subtitle_url(manual: Column, automatic: Column, language: str = "en") -> Column:
    """Manual track before automatic; a known format first, else the first entry."""

    def filled(tracks: Column) -> Column:
        listed = F.try_element_at(tracks, F.lit(language))
        return F.when(F.size(listed) > 0, listed)

    tracks = F.coalesce(filled(manual), filled(automatic))
    known = F.filter(tracks, lambda track: track["ext"].isin(*SUBTITLE_FORMATS))
    first_known = F.nullif(F.get(known, 0)["url"], F.lit(""))
    return F.coalesce(first_known, F.nullif(F.get(tracks, 0)["url"], F.lit("")))


def watch_url(url: Column, video_id: Column, prefix: str) -> Column:
    """The entry's URL, else one built from its id."""
    return F.coalesce(
        F.nullif(url, F.lit("")), F.concat(F.lit(prefix), F.coalesce(video_id, F.lit("")))
    )
