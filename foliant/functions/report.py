"""Quality report of a formatted article."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import TEXT_SPACE
from .text import count_words, let

_S = rf"[{TEXT_SPACE}]"

# Rules that look for leftovers, with the text of their issue.
LEFTOVERS = [
    (rf"(?md)^\*\*{_S}*$|^{_S}*\*\*$", "ORPHAN_BOLD: %d orphan ** markers"),
    (r"\[\]\([^)]*\)", "EMPTY_LINKS: %d empty []() links"),
    (r"\n{4,}", "EXCESSIVE_BLANKS: %d sections with 4+ blank lines"),
    ("\u00e2\u20ac[\u2122\u0153\"\u009d\u2014]", "ENCODING_ARTIFACTS: %d mojibake patterns"),
    ("\u00a0", "NBSP: %d non-breaking spaces remain"),
    (r"\*{4,}", "EMPTY_BOLD: %d empty **** markers"),
    (r'\[[^\]]*\]\([^)]*"[^"]*"\)', "TOOLTIP_LINKS: %d links with tooltip text"),
    (rf"(?imdu)^{_S}*\[?(?:Home|Back|Top){_S}*\|", "NAV_BOILERPLATE: %d navigation lines remain"),
]
HEADER_LINES = 8
POINTS_PER_ISSUE = 10


def _message(message: str):
    return lambda hits: F.when(hits > 0, F.format_string(message, hits))


def issues(text: Column) -> Column:
    """Issue texts in rule order; empty for a clean article."""
    header = F.substring_index(text, "\n", HEADER_LINES)

    def missing(label: str, text: str) -> Column:
        return F.when(~F.contains(header, F.lit(label)), text)

    found = [
        F.when(~text.startswith("# "), "MISSING_H1: Article doesn't start with H1 title"),
        missing("**Source:**", "MISSING_SOURCE: No **Source:** in header"),
        missing("**Category:**", "MISSING_CATEGORY: No **Category:** in header"),
    ]
    for pattern, message in LEFTOVERS:
        hits = F.regexp_count(text, F.lit(pattern))
        found.append(let(hits, _message(message)))
    return F.array_compact(F.array(*found))


def report(text: Column) -> Column:
    """valid, issues, score, line_count and word_count as one struct."""

    def graded(listed: Column) -> Column:
        return F.struct(
            (F.size(listed) == 0).alias("valid"),
            listed.alias("issues"),
            F.greatest(F.lit(0), 100 - POINTS_PER_ISSUE * F.size(listed)).alias("score"),
            F.size(F.split(text, "\n")).alias("line_count"),
            count_words(text, TEXT_SPACE).alias("word_count"),
        )

    return let(issues(text), graded)
