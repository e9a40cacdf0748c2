"""Web pages: title, main area, links and conversion to markdown.

Tags are rewritten by built-in expressions.  Python is used only where tags
must be balanced (the main area).
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .patterns import TEXT_SPACE
from .references import unescape
from .text import let, rewrite, strip_space

_S = rf"[{TEXT_SPACE}]"

# Parts of a page that carry no text.
HIDDEN = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script\b.*?</script>", ""),
    (r"(?is)<style\b.*?</style>", ""),
]

# Conversion rules, in order; white space is one space when they start.
TAG_RULES = [
    (r"(?i) ?<br\b[^>]*> ?", "  \n"),
    (r"(?i) ?<hr\b[^>]*> ?", "\n\n* * *\n\n"),
    *[(rf"(?i) ?<h{n}\b[^>]*> ?", "\n\n" + "#" * n + " ") for n in range(1, 7)],
    (r"(?i) ?<li\b[^>]*> ?", "\n  * "),
    (r"(?i) ?</li *> ?", "\n"),
    (r"(?i)</t[dh] *> ?", " | "),
    (
        r"(?i) ?</?(?:p|div|ul|ol|dl|table|tr|blockquote|section|article|main|header|footer|nav|h[1-6])\b[^>]*> ?",
        "\n\n",
    ),
    (r"(?i)</?(?:b|strong)\b[^>]*>", "**"),
    (r"(?i)</?(?:i|em)\b[^>]*>", "_"),
    (r"(?i)</?code\b[^>]*>", "`"),
    (r'(?is)<a\b[^>]*?\bhref *= *"([^"]*)"[^>]*>(.*?)</a *>', "[$2]($1)"),
    (r"(?is)<a\b[^>]*?\bhref *= *'([^']*)'[^>]*>(.*?)</a *>", "[$2]($1)"),
    (r"(?is)<a\b[^>]*?\bhref *= *([^\s\"'>]+)[^>]*>(.*?)</a *>", "[$2]($1)"),
    (r"<[^>]*>", ""),
    (r"\n{3,}", "\n\n"),
]

# Rules for tables that nest or leave cells open: an opening cell parts it from the one before.
OPEN_CELL_RULES = [
    (r"(?i)(<tr\b[^>]*> ?)<t[dh]\b[^>]*> ?", "$1"),
    (r"(?i)</t[dh] *> ?(?=<t[dh]\b)", ""),
    (r"(?i) ?<t[dh]\b[^>]*> ?", " | "),
]

# Main-area selectors by priority, link titles and schemes to skip.
AREA_SELECTORS = ("article", "main", ".content", "#content", ".article", "td[width]", "body")
SKIPPED_TITLES = ("", "home", "back", "top")
SKIPPED_SCHEMES = ("mailto:", "#", "javascript:")

# Parts of a blog post page.
POST_LINK_CLASS = "post-title"
POST_TITLE_SELECTORS = (".post-title", "h1.entry-title", "h3.post-title")
POST_BODY_SELECTORS = (".post-body", ".entry-content")
POST_DATE_SELECTORS = (".date-header", ".published", "time")


def _opening(selector: str) -> re.Pattern[str]:
    """Pattern of the opening tag a simple selector stands for; group 1 is the tag."""
    tag, mark, rest = re.fullmatch(r"([a-z0-9]*)([.#\[]?)(.*)", selector).groups()
    tag = tag or "[a-z][a-z0-9]*"
    if mark == ".":
        ask = rf"""[^>]*?\sclass\s*=\s*(?:"(?:[^"]*\s)?{rest}(?:\s[^"]*)?"|'(?:[^']*\s)?{rest}(?:\s[^']*)?'|{rest}(?=[\s>]))"""
    elif mark == "#":
        ask = rf"""[^>]*?\sid\s*=\s*(?:"{rest}"|'{rest}'|{rest}(?=[\s>]))"""
    elif mark == "[":
        ask = rf"[^>]*?\s{rest[:-1]}\b"
    else:
        ask = ""
    return re.compile(rf"<({tag})\b{ask}[^>]*>", re.IGNORECASE)


def balanced(html: str, start: re.Match[str]) -> str:
    """The element that opens at ``start``; to the end of the page if never closed."""
    depth = 0
    for tag in re.compile(rf"<(/?){start[1]}\b[^>]*>", re.IGNORECASE).finditer(html, start.start()):
        depth += -1 if tag[1] else 1
        if depth == 0:
            return html[start.start() : tag.end()]
    return html[start.start() :]


def area_udf(selectors: tuple[str, ...], by_priority: bool, fallback: bool):
    """The element of the first selector that fits (or of the earliest match)."""
    patterns = [_opening(s) for s in selectors]

    def find(html: str) -> str | None:
        hits = (p.search(html) for p in patterns)
        found = [h for h in hits if h]
        if not found:
            return html if fallback else None
        best = found[0] if by_priority else min(found, key=lambda h: h.start())
        return balanced(html, best)

    @F.pandas_udf(T.StringType())
    def area(html: pd.Series) -> pd.Series:
        return html.map(find, na_action="ignore").astype("object")

    return area


def visible(html: Column) -> Column:
    return rewrite(html, HIDDEN)


def content_area(html: Column) -> Column:
    return area_udf(AREA_SELECTORS, by_priority=True, fallback=True)(visible(html))


def inner_text(html: Column) -> Column:
    """Text of an element, every text piece trimmed and joined without a gap."""
    return unescape(strip_space(F.regexp_replace(html, rf"{_S}*(?:<[^>]*>{_S}*)+", "")))


def _first(html: Column, tag: str) -> Column:
    pattern = rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}{_S}*>"
    return F.when(html.rlike(pattern), F.regexp_extract(html, pattern, 1))


def page_title(html: Column) -> Column:
    """The title element, else the first heading of the highest level present."""
    titled = _first(html, "title")
    bare = F.when(~inner_blank(titled), titled)
    return F.coalesce(
        inner_text(
            F.coalesce(bare, _first(html, "h1"), _first(html, "h2"), _first(html, "h3"))
        ),
        F.lit(""),
    )


def inner_blank(html: Column) -> Column:
    return F.coalesce(F.regexp_replace(html, rf"<[^>]*>|{_S}", "") == "", F.lit(True))


def _inside(html: Column, tag: str, inner, outer=lambda part: part) -> Column:
    """``inner`` of what stands between the tags of an element, ``outer`` of the rest; elements do not nest."""
    cut = F.split(html, rf"(?i) ?<{tag}\b[^>]*> ?| ?</{tag}{_S}*> ?")
    parts = F.transform(cut, lambda part, i: F.when(i % 2 == 1, inner(part)).otherwise(outer(part)))
    return F.array_join(parts, "")


def _table_rows(rows: Column) -> Column:
    """Rows of a table between bars, a ruler below the first."""

    def row(text: Column) -> Column:
        cells = F.split(F.regexp_replace(text, r"(?i) ?<t(?:[dhr]|head|body|foot)\b[^>]*> ?", ""), r"(?i) ?</t[dh] *> ?")
        kept = F.slice(cells, 1, F.size(cells) - 1)
        line = F.concat(F.lit("| "), F.array_join(kept, " | "), F.lit(" |"))
        return F.struct(F.size(kept).alias("n"), line.alias("line"))

    def laid(listed: Column) -> Column:
        def line(r: Column, i: Column) -> Column:
            ruler = F.concat(F.lit("\n|"), F.repeat(F.lit(" --- |"), r["n"]))
            return F.when(i == 0, F.concat(r["line"], ruler)).otherwise(r["line"])

        return F.concat(F.lit("\n\n"), F.array_join(F.transform(listed, line), "\n"), F.lit("\n\n"))

    found = F.transform(F.split(rows, r"(?i) ?</tr *> ?"), row)
    return let(F.filter(found, lambda r: r["n"] > 0), laid)


def _in_turn(html: Column, tag: str) -> Column:
    """An opening and a closing mark for each such tag, in order."""
    return F.array_join(F.regexp_extract_all(html, F.lit(rf"(?i)(</?){tag}\b"), F.lit(1)), "")


def _tables(html: Column) -> Column:
    """Tables as rows between bars; tables that nest, or have open cells, keep all text by the plain rules."""

    def rows(part: Column) -> Column:
        def laid(p: Column) -> Column:
            last = F.transform(F.split(p, r"(?i) ?</tr *> ?"), lambda row: F.regexp_replace(row, r"(?is)\A.*</t[dh] *>", ""))
            behind = F.regexp_replace(F.array_join(last, ""), r"<[^>]*>", "")
            bars = F.when(behind.rlike(rf"\A{_S}*+\z"), _table_rows(p))
            plain = F.concat(F.lit("\n\n"), rewrite(p, OPEN_CELL_RULES), F.lit("\n\n"))
            return F.coalesce(F.when(_in_turn(p, "t[dh]").rlike(r"\A(?:<</)*+\z"), bars), plain)

        return let(part, laid)

    # The last table may be open.
    def laid(text: Column) -> Column:
        apart = _in_turn(text, "table").rlike(r"\A(?:<</)*+<?\z")
        return F.when(apart, _inside(text, "table", rows)).otherwise(rewrite(text, OPEN_CELL_RULES))

    return let(html, laid)


# Elements that hold blocks; all other tags are rewritten where they stand.
_HOLDERS = r"(?i)</?(?:ol|ul|li|blockquote|pre)\b[^>]*>"
_DEEP = r"(?is)<(?:ol|blockquote|pre)\b|<ul\b.*<ul\b"

# Signs that no text has: a level of quoting at the start of a line, and what parts the marks of a page.
_LEVEL, _NEXT, _FIELD = "\ue001", "\ue002", "\ue003"
_PLACE = "struct<lists:array<int>,quotes:int,pre:boolean,out:string>"


# Of several blank lines one stays; it has no level if one of them has none.
_BLANK_RUNS = [
    (rf"(?:\n{_LEVEL}*)*\n(?=\n)(?:\n{_LEVEL}*)*\n({_LEVEL}*)(?=[^\n{_LEVEL}])", "\n\n$1", "\n\n"),
    (rf"(?:\n{_LEVEL}*)*\n({_LEVEL}*)\n({_LEVEL}*)(?=[^\n{_LEVEL}])", "\n$1\n$2", _LEVEL),
]


def _lines(count: int, quotes: Column) -> Column:
    return F.repeat(F.concat(F.lit("\n"), F.repeat(F.lit(_LEVEL), quotes)), F.lit(count))


def _enter(place: Column, tag: Column) -> Column:
    """The lists, quotes and preformatted text that are open behind a tag, and what stands in its place."""
    lists, quotes = place["lists"], place["quotes"]
    name = F.lower(F.regexp_extract(tag, r"\A</?([a-zA-Z]+)", 1))
    closing = tag.startswith("</")
    depth = F.size(lists)

    def moved(before, lists=lists, quotes=quotes, pre=F.lit(False)) -> Column:
        record = F.concat(F.lit(_NEXT), before, F.lit(_FIELD), quotes.cast("string"), F.lit(_FIELD), pre.cast("string"))
        parts = dict(lists=lists, quotes=quotes, pre=pre, out=F.concat(place["out"], record))
        return F.struct(*[c.alias(n) for n, c in parts.items()]).cast(_PLACE)

    start = F.coalesce(F.regexp_extract(tag, r"(?i)\bstart\s*=\s*[\"']?\s*(\d{1,9})", 1).try_cast("int"), F.lit(1)) - 1
    number = F.get(lists, depth - 1) + 1
    ordered = F.coalesce(number >= 0, F.lit(False))
    counted = F.when(ordered, F.concat(F.slice(lists, 1, depth - 1), F.array(number))).otherwise(lists)
    mark = F.when(ordered, F.concat(number.cast("string"), F.lit(". "))).otherwise("* ")
    item = F.concat(_lines(1, quotes), F.repeat(F.lit("  "), F.greatest(depth, F.lit(1))), mark)
    less = F.slice(lists, 1, F.greatest(depth - 1, F.lit(0)))
    fewer = F.greatest(quotes - 1, F.lit(0))
    fenced = F.concat(_lines(2, quotes), F.lit("```"), _lines(1, quotes))
    unfenced = F.concat(_lines(1, quotes), F.lit("```"), _lines(2, quotes))
    quoted = F.concat(_lines(1, quotes), _lines(1, quotes + 1))
    around = F.when(depth == 0, _lines(2, quotes)).otherwise("")
    behind = F.when(depth <= 1, _lines(2, quotes)).otherwise("")
    return (
        F.when(place["pre"] & ((name != "pre") | ~closing), moved(F.lit(""), pre=F.lit(True)))
        .when(name == "pre", F.when(closing, F.when(place["pre"], moved(unfenced)).otherwise(moved(F.lit("")))).otherwise(moved(fenced, pre=F.lit(True))))
        .when(name == "blockquote", F.when(closing, moved(_lines(2, fewer), quotes=fewer)).otherwise(moved(quoted, quotes=quotes + 1)))
        .when(name == "li", F.when(closing, moved(_lines(1, quotes))).otherwise(moved(item, lists=counted)))
        .when(closing, moved(behind, lists=less))
        .when(name == "ol", moved(around, lists=F.concat(lists, F.array(start))))
        .otherwise(moved(around, lists=F.concat(lists, F.array(F.lit(-2)))))
    )


def _flat(text: Column) -> Column:
    """Markdown of text without elements that hold blocks; white space is one space."""
    tables = F.when(text.rlike(r"(?i)<t[dhr]\b|<table\b"), _tables(text)).otherwise(text)
    return let(tables, lambda t: F.when(F.contains(t, F.lit("<")), _tags(t)).otherwise(t))


def _tags(text: Column) -> Column:
    """Applies ``TAG_RULES``; a rule whose tags the text has not is left out.

    No rule puts a tag together that was not there, so the tags are looked up once.
    """
    names = F.lower(F.array_join(F.regexp_extract_all(text, F.lit("<(/?[a-zA-Z][a-zA-Z0-9]*)"), F.lit(1)), "> <"))

    def chain(found: Column) -> Column:
        value = text
        for pattern, replacement, *_ in TAG_RULES:
            value = _if_tagged(value, found, pattern, replacement)
        return value

    return let(F.concat(F.lit("<"), names, F.lit(">")), chain)


def _if_tagged(value: Column, found: Column, pattern: str, replacement: str) -> Column:
    named = re.match(r"\(\?[is]+\) ?\??<(.+?)(?:\\b| ?\*)", pattern)
    if not named:
        return F.regexp_replace(value, pattern, replacement)
    return let(value, lambda v: F.when(found.rlike(f"<{named[1]}>"), F.regexp_replace(v, pattern, replacement)).otherwise(v))


def _structured(html: Column) -> Column:
    """One fold over the tags of lists, quotes and preformatted text; what stands between them is flat."""
    start = F.struct(
        F.array().cast("array<int>").alias("lists"), F.lit(0).alias("quotes"), F.lit(False).alias("pre"), F.lit("").alias("out")
    ).cast(_PLACE)
    found = F.struct(F.regexp_extract_all(html, F.lit(_HOLDERS), F.lit(0)).alias("tags"), F.split(html, _HOLDERS).alias("texts"))

    def laid(f: Column) -> Column:
        last = F.size(f["tags"])

        def joined(place: Column) -> Column:
            def one(text: Column, i: Column) -> Column:
                def written(record: Column) -> Column:
                    quotes = F.coalesce(F.get(record, 1).try_cast("int"), F.lit(0))
                    raw = F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", ""), r"\A\n|\s+\z", "")
                    inner = F.regexp_replace(F.regexp_replace(text, rf"{_S}+", " "), F.when(i > 0, r"\A ").otherwise(r"\A\b\B"), "")
                    inner = F.regexp_replace(inner, F.when(i < last, r" \z").otherwise(r"\A\b\B"), "")
                    shown = F.when(F.get(record, 2) == "true", raw).otherwise(_flat(inner))
                    quoted = F.when(quotes > 0, F.replace(shown, F.lit("\n"), _lines(1, quotes))).otherwise(shown)
                    return F.concat(F.coalesce(F.get(record, 0), F.lit("")), quoted)

                return let(F.split(F.get(F.split(place["out"], _NEXT), i), _FIELD), written)

            ended = F.when(place["pre"], F.concat(_lines(1, place["quotes"]), F.lit("```"))).otherwise("")
            return F.concat(F.array_join(F.transform(f["texts"], one), ""), ended)

        return F.aggregate(f["tags"], start, _enter, joined)

    return let(found, laid)


def _quoted_lines(text: Column) -> Column:
    """Lines with a mark for every level of quoting; of blank lines one stays, on the lower level beside it."""

    def level(line: Column) -> Column:
        return F.coalesce(F.length(F.regexp_extract(line, rf"\A{_LEVEL}+", 0)), F.lit(0))

    def blank(line: Column) -> Column:
        return line.rlike(rf"\A[{_LEVEL} ]*\z")

    def kept(lines: Column) -> Column:
        return F.filter(lines, lambda x, i: ~blank(x) | ((i > 0) & ~F.coalesce(blank(F.get(lines, i - 1)), F.lit(True))))

    def marked(lines: Column) -> Column:
        def one(line: Column, i: Column) -> Column:
            own = F.when(blank(line), F.least(level(line), level(F.get(lines, i - 1)), level(F.get(lines, i + 1)))).otherwise(level(line))
            bare = F.regexp_replace(line, rf"\A{_LEVEL}+", "")
            return F.concat(F.repeat(F.lit("> "), own), F.when(blank(line), "").otherwise(bare))

        return F.array_join(F.transform(lines, one), "\n")

    laid = let(F.split(strip_space(text), "\n"), lambda lines: let(kept(lines), marked))
    trimmed = F.regexp_replace(laid, r"\A(?:(?:> )*\n)+|(?:\n(?:> )*)+\z", "")
    return F.when(F.contains(text, F.lit(_LEVEL)), trimmed).otherwise(text)


def tags_to_markdown(html: Column) -> Column:
    """Markdown with character references still in place.

    Lists keep their depth and numbers, also those that do not start at one, quotes a mark
    for every level, preformatted text its lines, and tables get a ruler.
    """

    def made(page: Column) -> Column:
        return F.when(page.rlike(_DEEP), let(rewrite(_structured(page), _BLANK_RUNS), _quoted_lines)).otherwise(
            _flat(F.regexp_replace(page, rf"{_S}+", " "))
        )

    return strip_space(let(visible(html), made))


def to_markdown(html: Column) -> Column:
    return collapse_newlines(unescape(tags_to_markdown(html)))


def collapse_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n{4,}", "\n\n\n")


_ANCHOR = (
    r"(?is)<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))[^>]*>(.*?)</a\s*>"
)


def links(html: Column) -> Column:
    """Title and target of every kept link of a page, in order.

    Text and targets keep their character references.
    """

    def link(anchor: Column) -> Column:
        href = F.concat(*[F.regexp_extract(anchor, _ANCHOR, g) for g in (1, 2, 3)])
        text = F.regexp_replace(
            F.regexp_extract(anchor, _ANCHOR, 4), rf"{_S}*(?:<[^>]*>{_S}*)+", ""
        )
        return F.struct(strip_space(text).alias("title"), href.alias("href"))

    anchors = F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(0))
    return F.filter(F.transform(anchors, link), keeps_link)


def keeps_link(link: Column) -> Column:
    keep = ~F.lower(link["title"]).isin(*SKIPPED_TITLES)
    for scheme in SKIPPED_SCHEMES:
        keep = keep & ~link["href"].startswith(scheme)
    return keep


def assemble_document(title: Column, url: Column, category: Column, body: Column) -> Column:
    return F.concat(
        F.lit("# "), title, F.lit("\n\n**Source:** ["), url, F.lit("]("), url,
        F.lit(")\n\n**Category:** "), category, F.lit("\n\n---\n\n"), body,
    )


def external_stub(title: Column, url: Column) -> Column:
    return F.concat(
        F.lit("# "), title, F.lit("\n\n**External Link:** ["), url, F.lit("]("), url,
        F.lit(")\n\nThis article is hosted on an external website.\n"),
    )
