"""Formatter passes over documents with leftovers written into them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markup, report
from ..operators import formatting
from .base import query, say, source_number, sql_text, texts

OWNERS = ("Acme Press", "Example House")
SITES = {"host.example": "Example Host"}


def cleaned(spark, sf_dir, markdown, clean):
    """The result of one pass over markdown made from every document."""
    made = texts(spark, sf_dir).select("doc_id", "source", "lang", markdown.alias("markdown"))
    return made.select("doc_id", clean(F.col("markdown")).alias("cleaned"))


def _text():
    return F.col("text")


_BEFORE = "Home | Back | Top\n[ Next ]\n"
_AFTER = (
    "\nShare this:\nTweet\nTweet 12\n## Comments\nNo comments.\nPosted in News\n"
    "A line. Copyright © Acme Press 2024\nGod bless you all.\n[Read more](http://host.example/m)\n"
    "[](<https://blogger.googleusercontent.com/a.png>)\n[](http://host.example/z)\n"
)


def _prose():
    """The text without characters that are marks in markdown, of which it has some of its own."""
    return F.translate(_text(), "*_#", "")


_PROSE = "translate(text, '*_#', '')"


@query(
    "boilerplate_clean",
    r"""SELECT doc_id, E'\n\n' || text || E'\n' AS cleaned FROM documents""",
)
def boilerplate_clean(spark, sf_dir):
    made = say(_BEFORE, _text(), _AFTER)
    return cleaned(spark, sf_dir, made, lambda m: markup.remove_boilerplate(m, OWNERS))


@query(
    "unicode_normalize",
    """SELECT doc_id, replace(text, chr(10), ' ') || E' x\\ny\\n' || chr(8217) || chr(8220) || chr(8221) || chr(8212)
        AS cleaned FROM documents""",
)
def unicode_normalize(spark, sf_dir):
    dirty = say(
        F.replace(_text(), F.lit("\n"), F.lit("\u00a0\u200b")),
        "\u00a0\ufeffx\u200e\u2028\u200fy\u2029",
        "\u00e2\u20ac\u2122\u00e2\u20ac\u0153\u00e2\u20ac\u009d\u00e2\u20ac\"",
    )
    return cleaned(spark, sf_dir, dirty, markup.normalize_unicode)


_LINKS = (
    '[a](<http://h.example/1> "tip") [b](http://h.example/2 "tip") [c](<http://h.example/3>) '
    "[](http://h.example/4) [d]( ) [e](http://h.example/x_(y)_z) "
)
_CLEAN_LINKS = (
    "[a](http://h.example/1) [b](http://h.example/2) [c](http://h.example/3) "
    " d [e](<http://h.example/x_(y)_z>) "
)


@query(
    "links_clean",
    f"""SELECT doc_id, '{_CLEAN_LINKS}' || text || '{_CLEAN_LINKS}' AS cleaned FROM documents""",
)
def links_clean(spark, sf_dir):
    return cleaned(spark, sf_dir, say(_LINKS, _text(), _LINKS), markup.clean_links)


_BREAK = "  \n* * *\n  \n\n_ _ _\n- - -\n***\n\n\n\n  indented\n"


@query(
    "rules_whitespace",
    r"""SELECT doc_id, replace(text, chr(10), E'\n---\nindented\n') || E'\n\n---' AS cleaned FROM documents""",
)
def rules_whitespace(spark, sf_dir):
    made = say(F.replace(_text(), F.lit("\n"), F.lit(_BREAK)), "\n\n---\n## \n")

    def clean(m):
        return markup.remove_trailing(markup.normalize_whitespace(markup.normalize_rules(m)))

    return cleaned(spark, sf_dir, made, clean)


@query(
    "headings_clean",
    r"""SELECT doc_id, array_to_string(list_transform(list_filter(string_split(m, chr(10)),
            lambda x: NOT regexp_matches(x, '^#{1,6}\s*\*{0,4}\s*$')),
        lambda x: regexp_replace(CASE WHEN regexp_matches(x, '^# [^#]') THEN '#' || x ELSE x END,
            '^(#{1,6})\s*\*\*(.+?)\*\*\s*$', '\1 \2')), chr(10)) AS cleaned
    FROM (SELECT doc_id, '# **' || replace(text, chr(10), E'** \n## ****\n# ') || E'\n#' AS m FROM documents)""",
)
def headings_clean(spark, sf_dir):
    made = say("# **", F.replace(_text(), F.lit("\n"), F.lit("** \n## ****\n# ")), "\n#")
    return cleaned(spark, sf_dir, made, markup.normalize_headings)


@query(
    "title_dedup",
    """SELECT doc_id, E'\\n' || text || E'\\n' || source || ' report in full' AS cleaned FROM documents""",
)
def title_dedup(spark, sf_dir):
    title = say("The ", F.col("source"), " report 2024")
    made = texts(spark, sf_dir).select(
        "doc_id",
        title.alias("title"),
        say(
            "\n## **the ", F.col("source"), " REPORT 2024** \n", F.col("text"), "\n", F.col("source"),
            " report in full",
        ).alias("markdown"),
    )
    return made.select(
        "doc_id", markup.remove_repeated_title(F.col("markdown"), F.col("title")).alias("cleaned")
    )


@query(
    "metadata_lines",
    rf"""SELECT doc_id, 'Writer ' || source AS author, '2024-01-' || (doc_id % 28 + 1) AS date,
        regexp_replace(m, '(?m)^\*(?:Published|Date|Author|Keyword):[^\n]*?\*\s*$', '', 'g') AS cleaned
    FROM (SELECT doc_id, source, text || E'\n*Author: Writer ' || source || E'*\n*Date:  2024-01-' || (doc_id % 28 + 1)
        || E' * \nmore' AS m FROM documents)""",
)
def metadata_lines(spark, sf_dir):
    doc = F.col("doc_id")
    made = texts(spark, sf_dir).select(
        "doc_id",
        say(
            F.col("text"), "\n*Author: Writer ", F.col("source"), "*\n*Date:  2024-01-", doc % 28 + 1, " * \nmore"
        ).alias("m"),
    )
    return made.select(
        "doc_id",
        markup.metadata_field(F.col("m"), "Author").alias("author"),
        markup.metadata_field(F.col("m"), "Date").alias("date"),
        markup.without_metadata(F.col("m")).alias("cleaned"),
    )


@query(
    "emphasis_fix",
    r"""SELECT doc_id, '***' || replace(translate(text, '*_#', ''), chr(10), E'***\n**x\n***') || '*** and **y**' AS cleaned
    FROM documents""",
)
def emphasis_fix(spark, sf_dir):
    made = say(
        "_**", F.replace(_prose(), F.lit("\n"), F.lit("**_\n__x__ ****\n**\n_**")), "**_ and ****y****"
    )
    return cleaned(spark, sf_dir, made, markup.fix_emphasis)


@query(
    "tables_clean",
    r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(m, '(?m)^\|[\s|]*\|\s*$', '', 'g'),
            '(?m)^\|\s+---\s+\|$', '| --- |', 'g'),
        '\|[^\n]+\|\n\|[-:\s|]+\|\n(\n|$)', '\1', 'g') AS cleaned
    FROM (SELECT doc_id, E'|  |  |\n| a |\n|   ---   |\n| ' || replace(text, chr(10), E' |\n|  | |\n| ')
        || E' |\n\n| only | head |\n| --- | --- |\n\nend' AS m FROM documents)""",
)
def tables_clean(spark, sf_dir):
    rows = F.replace(_text(), F.lit("\n"), F.lit(" |\n|  | |\n| "))
    made = say("|  |  |\n| a |\n|   ---   |\n| ", rows, " |\n\n| only | head |\n| --- | --- |\n\nend")
    return cleaned(spark, sf_dir, made, markup.clean_tables)


@query(
    "dup_halves",
    """SELECT doc_id, alike, CASE WHEN alike THEN length(text) ELSE length(m) END AS chars
    FROM (SELECT doc_id, text, doc_id % 2 = 0 AND 2 * length(text) + 2 >= 500 AS alike, text || chr(10) || CASE
            WHEN doc_id % 2 = 0 THEN chr(10) || text ELSE replace(chr(10) || text, chr(10), chr(10) || '> ') END AS m
        FROM documents)""",
)
def dup_halves(spark, sf_dir):
    """Even documents are repeated; in odd ones every line of the second half differs a little."""
    again = F.when(F.col("doc_id") % 2 == 0, say("\n", _text())).otherwise(
        F.replace(say("\n", _text()), F.lit("\n"), F.lit("\n> "))
    )
    made = texts(spark, sf_dir).select("doc_id", say(_text(), "\n", again).alias("m"))
    return made.withColumn("alike", markup.halves_alike(F.col("m"))).select(
        "doc_id",
        "alike",
        F.when(F.col("alike"), F.length(markup.first_half(F.col("m"))))
        .otherwise(F.length("m"))
        .alias("chars"),
    )


@query(
    "format_detect",
    """SELECT doc_id, doc_id % 3 <> 0 AS formatted FROM documents""",
)
def format_detect(spark, sf_dir):
    doc = F.col("doc_id")
    header = (
        F.when(doc % 3 == 0, "# T\n\n**Source:** x\n\n**Kind:** y\n\n")
        .when(doc % 3 == 1, "# T\n\n**Source:** x\n\n\n**Category:** y\n")
        .otherwise("# T\n\n**Source:** x\n\n**Category:** y\n\n---\n")
    )
    made = texts(spark, sf_dir).select("doc_id", say(header, _text()).alias("m"))
    return made.select("doc_id", markup.is_formatted(F.col("m")).alias("formatted"))


@query(
    "header_build",
    r"""SELECT doc_id, '# ' || CASE WHEN doc_id % 2 = 0 THEN 'The Great Report \[' ELSE 'The great report \[' END || doc_id
        || E'\\]\n\n**Source:** [Example Host](https://host.example/' || doc_id || E')\n\n**Category:** '
        || format('{:02d}', CAST(regexp_extract(source, '(\d+)$', 1) AS INTEGER) + 1) || ' Topic ' || source
        || CASE WHEN doc_id % 3 = 0 THEN E'\n\n**Author:** A. Writer' ELSE '' END
        || CASE WHEN doc_id % 4 = 0 THEN E'\n\n**Date:** 2024' ELSE '' END || E'\n\n---\n\n' AS header
    FROM documents""",
)
def header_build(spark, sf_dir):
    doc = F.col("doc_id")
    title = F.when(doc % 2 == 0, say(" THE GREAT REPORT [", doc, "] ")).otherwise(
        say("The great report [", doc, "]")
    )
    header = markup.build_header(
        title,
        say("https://host.example/", doc),
        source_number(),
        say("Topic ", F.col("source")),
        F.when(doc % 3 == 0, "A. Writer"),
        F.when(doc % 4 == 0, "2024"),
        SITES,
    )
    return texts(spark, sf_dir).select("doc_id", header.alias("header"))


def dirty_articles(spark, sf_dir):
    """Every document with its title repeated, leftovers of all kinds and metadata."""
    doc, text = F.col("doc_id"), _prose()
    title = say("Report ", doc, " of ", F.col("source"))
    markdown = say(
        "# **", title, "**\n", _BEFORE, "*Author: Writer*\n",
        F.replace(text, F.lit("\n"), F.lit("  \n\n* * *\n\n\n\n")), _LINKS, "__bold__ _**both**_\n", _AFTER,
    )
    return texts(spark, sf_dir).select(
        "doc_id",
        title.alias("title"),
        markdown.alias("markdown"),
        say("https://host.example/", doc).alias("source_url"),
        source_number().alias("category_id"),
        say("Topic ", F.col("source")).alias("category_name"),
    )


@query(
    "format_articles",
    rf"""SELECT doc_id, '# Report ' || doc_id || ' of ' || source || E'\n\n**Source:** [Example Host](https://host.example/'
        || doc_id || E')\n\n**Category:** ' || format('{{:02d}}', CAST(regexp_extract(source, '(\d+)$', 1) AS INTEGER) + 1)
        || ' Topic ' || source || E'\n\n**Author:** Writer\n\n---\n\n' || replace({_PROSE}, chr(10), E'\n\n---\n')
        || '{_CLEAN_LINKS}**bold** ***both***' || chr(10) AS formatted FROM documents""",
)
def format_articles(spark, sf_dir):
    """All passes together."""
    return formatting.format_markdown(
        dirty_articles(spark, sf_dir), owners=OWNERS, sites=SITES
    ).select("doc_id", "formatted")


REPORT_SQL = r"""
    SELECT doc_id, len(issues) = 0 AS valid, array_to_string(issues, '; ') AS issues,
        CAST(greatest(0, 100 - 10 * len(issues)) AS INTEGER) AS score,
        CAST(len(string_split(m, chr(10))) AS INTEGER) AS line_count,
        CAST(len(regexp_extract_all(m, '[^\s\x{85}\x{a0}\x{2028}\x{2029}]+')) AS INTEGER) AS word_count
    FROM (SELECT doc_id, m, list_filter([
        CASE WHEN NOT starts_with(m, '# ') THEN 'MISSING_H1: Article doesn''t start with H1 title' END,
        CASE WHEN NOT contains(h, '**Source:**') THEN 'MISSING_SOURCE: No **Source:** in header' END,
        CASE WHEN NOT contains(h, '**Category:**') THEN 'MISSING_CATEGORY: No **Category:** in header' END,
        CASE WHEN ob > 0 THEN 'ORPHAN_BOLD: ' || ob || ' orphan ** markers' END,
        CASE WHEN el > 0 THEN 'EMPTY_LINKS: ' || el || ' empty []() links' END,
        CASE WHEN eb > 0 THEN 'EXCESSIVE_BLANKS: ' || eb || ' sections with 4+ blank lines' END,
        CASE WHEN ea > 0 THEN 'ENCODING_ARTIFACTS: ' || ea || ' mojibake patterns' END,
        CASE WHEN nb > 0 THEN 'NBSP: ' || nb || ' non-breaking spaces remain' END,
        CASE WHEN bo > 0 THEN 'EMPTY_BOLD: ' || bo || ' empty **** markers' END,
        CASE WHEN tl > 0 THEN 'TOOLTIP_LINKS: ' || tl || ' links with tooltip text' END,
        CASE WHEN nv > 0 THEN 'NAV_BOILERPLATE: ' || nv || ' navigation lines remain' END],
        lambda x: x IS NOT NULL) AS issues
    FROM (SELECT doc_id, m, array_to_string(string_split(m, chr(10))[1:8], chr(10)) AS h,
        len(regexp_extract_all(m, '(?m)^\*\*\s*$|^\s*\*\*$')) AS ob,
        len(regexp_extract_all(m, '\[\]\([^)]*\)')) AS el,
        len(regexp_extract_all(m, '\n{4,}')) AS eb,
        len(regexp_extract_all(m, '\x{e2}\x{20ac}[\x{2122}\x{153}"\x{9d}\x{2014}]')) AS ea,
        len(regexp_extract_all(m, '\x{a0}')) AS nb,
        len(regexp_extract_all(m, '\*{4,}')) AS bo,
        len(regexp_extract_all(m, '\[[^\]]*\]\([^)]*"[^"]*"\)')) AS tl,
        len(regexp_extract_all(m, '(?im)^\s*\[?(?:Home|Back|Top)\s*\|')) AS nv
    FROM made))
"""


@query(
    "format_report",
    f"""WITH made AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN E'# T\\n\\n**Source:** s\\n\\n**Category:** c\\n\\n' ELSE '' END
        || {sql_text(_BEFORE)} || replace(text, ' the ', chr(160) || 'the**** ') || {sql_text(_LINKS)}
        || chr(226) || chr(8364) || '"' || E'\\n**\\n\\n\\n\\nend' AS m FROM documents)
    {REPORT_SQL}""",
)
def format_report(spark, sf_dir):
    header = F.when(F.col("doc_id") % 2 == 0, "# T\n\n**Source:** s\n\n**Category:** c\n\n").otherwise("")
    made = texts(spark, sf_dir).select(
        "doc_id",
        say(
            header, _BEFORE, F.replace(_text(), F.lit(" the "), F.lit("\u00a0the**** ")), _LINKS,
            "\u00e2\u20ac\"", "\n**\n\n\n\nend",
        ).alias("m"),
    )
    graded = made.select("doc_id", report.report(F.col("m")).alias("r"))
    return graded.select(
        "doc_id", "r.valid", F.array_join("r.issues", "; ").alias("issues"), "r.score", "r.line_count", "r.word_count"
    )
