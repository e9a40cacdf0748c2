"""Fields of an article file: title, source URL, category and body.

Each field is one anchored search over the whole text, so the scan stops at the
first hit and no array of lines is built.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import WEB_SPACE, on_line
from .text import let, strip_space

_GAP = on_line(WEB_SPACE)
_LINE = rf"(?:\A|\n){_GAP}*"
_RULE = rf"{_LINE}---{_GAP}*(?:\n|\z)"
_LINE_CHAR = r"[^\n\r\u2028\u2029]"


def _labelled_line(raw: Column, label: str) -> Column:
    return F.regexp_extract(raw, rf"{_LINE}(\*\*{label}:\*\*[^\n]*)", 1)


def _after_label(line: Column, label: str) -> Column:
    return strip_space(
        F.regexp_replace(line, rf"^\*\*{label}:\*\*[{WEB_SPACE}]*", ""), WEB_SPACE
    )


def title(raw: Column, filename: Column) -> Column:
    """First line that starts with `#`, else the file name in words."""
    line = F.regexp_extract(raw, rf"{_LINE}(#[^\n]*)", 1)
    heading = strip_space(F.regexp_replace(line, rf"^#+[{WEB_SPACE}]*", ""), WEB_SPACE)
    stem = F.regexp_replace(F.regexp_replace(filename, r"\.md\z", ""), r"^\d+_", "")
    return F.coalesce(F.nullif(heading, F.lit("")), F.translate(stem, "_", " "))


def source_url(raw: Column) -> Column:
    """First parenthesised text on the Source line, else what follows the label."""

    def target(line: Column) -> Column:
        linked = strip_space(F.regexp_extract(line, r"\(([^)]+)\)", 1), WEB_SPACE)
        return F.when(line.rlike(r"\([^)]+\)"), linked).otherwise(
            F.nullif(_after_label(line, "Source"), F.lit(""))
        )

    return let(strip_space(_labelled_line(raw, "Source"), WEB_SPACE), target)


def category_name(raw: Column) -> Column:
    """Text of the Category line, empty when there is none."""
    return _after_label(_labelled_line(raw, "Category"), "Category")


def body(raw: Column) -> Column:
    """Text after the first rule line, else the whole file; line ends unified."""
    unix = F.replace(raw, F.lit("\r\n"), F.lit("\n"))
    return F.coalesce(
        strip_space(F.get(F.split(unix, _RULE, 2), 1), WEB_SPACE), strip_space(raw, WEB_SPACE)
    )


def shown_title(raw: Column, slug: Column) -> Column:
    """Reader's title: the first level-one heading with text, else the slug."""
    heading = F.regexp_extract(raw, rf"{_LINE}# ([^\n]*[^{WEB_SPACE}][^\n]*)", 1)
    return F.coalesce(F.nullif(strip_space(heading, WEB_SPACE), F.lit("")), slug)


def shown_source_url(raw: Column) -> Column:
    """Reader's source URL: only the link form counts, NULL otherwise."""
    link = rf"\*\*Source:\*\*{_GAP}*\[{_LINE_CHAR}*?\]\(({_LINE_CHAR}*?)\)"
    return F.when(raw.rlike(link), F.regexp_extract(raw, link, 1))


def shown_body(raw: Column) -> Column:
    """Reader's body: as `body`, carriage returns inside the text kept."""
    return strip_space(F.coalesce(F.get(F.split(raw, _RULE, 2), 1), raw), WEB_SPACE)
