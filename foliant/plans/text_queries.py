"""Text queries over documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import chunks, cues, header, text
from ..operators import articles
from ..sinks import reports
from .base import (
    SOURCE_NUMBER,
    documents,
    query,
    say,
    source_number,
    sql_rewrite,
    sql_tokens,
    sql_trim,
    sql_words,
    table,
    texts,
)

CONTENT_WORD = r"[^\s#*`_~\[\]()>|]+"

PLAIN_RULES = [
    (r"#{1,6}\s+", "''"),
    (r"\*{1,3}([^*]+)\*{1,3}", r"'\1'"),
    (r"\[([^\]]+)\]\([^)]+\)", r"'\1'"),
    (r"`[^`]+`", "''"),
    (r"\n{2,}", "' '"),
    (r"\n", "' '"),
    (r"\s{2,}", "' '"),
]


def sql_plain(text: str) -> str:
    return sql_trim(sql_rewrite(text, PLAIN_RULES))


def sql_excerpt(text: str) -> str:
    return rf"""CASE WHEN length({text}) <= 150 THEN {text}
        ELSE regexp_replace(left({text}, 150), '(.) [^ ]*$', '\1', 's') || '…' END"""


@query(
    "word_count_stub",
    f"""SELECT doc_id, {sql_words("text", CONTENT_WORD)} AS word_count,
        {sql_words("text")} AS plain_words, {sql_words("text", CONTENT_WORD)} < 50 AS is_stub
    FROM documents""",
)
def word_count_stub(spark, sf_dir):
    words = text.count_content_words(F.col("text"))
    return texts(spark, sf_dir).select(
        "doc_id",
        words.alias("word_count"),
        text.count_words(F.col("text")).alias("plain_words"),
        text.is_stub(words).alias("is_stub"),
    )


@query("strip_markdown", f"SELECT doc_id, {sql_plain('text')} AS plain FROM documents")
def strip_markdown(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", text.strip_markdown(F.col("text")).alias("plain"))


@query(
    "strip_markdown_turns", f"SELECT conv_id, turn, {sql_plain('text')} AS plain FROM conversations"
)
def strip_markdown_turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", text.strip_markdown(F.col("text")).alias("plain")
    )


@query(
    "excerpt_150",
    f"""SELECT doc_id, {sql_excerpt("plain")} AS excerpt
    FROM (SELECT doc_id, {sql_plain("text")} AS plain FROM documents)""",
)
def excerpt_150(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", text.excerpt(F.col("text")).alias("excerpt"))


@query(
    "read_time",
    f"""SELECT doc_id,
        greatest(1, CAST(floor({sql_words("text")} / 200.0 + 0.5) AS INTEGER)) AS minutes
    FROM documents""",
)
def read_time(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "doc_id", text.read_minutes(text.count_words(F.col("text"))).alias("minutes")
    )


@query(
    "min_words",
    f"SELECT doc_id, {sql_words('text')} AS words FROM documents WHERE {sql_words('text')} >= 50",
)
def min_words(spark, sf_dir):
    return (
        texts(spark, sf_dir)
        .select("doc_id", text.count_words(F.col("text")).alias("words"))
        .where(~text.is_stub(F.col("words")))
    )


@query(
    "paragraph_split",
    rf"""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS position,
        paragraph
    FROM (SELECT doc_id, generate_subscripts(p, 1) AS i, unnest(p) AS paragraph
        FROM (SELECT doc_id, list_transform(
            regexp_split_to_array(replace(text, chr(10), chr(10) || chr(10)), '\n\n+'),
            lambda x: {sql_trim("x")}) AS p FROM documents))
    WHERE paragraph <> ''""",
)
def paragraph_split(spark, sf_dir):
    spaced = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    return texts(spark, sf_dir).select(
        "doc_id", F.posexplode(chunks.paragraphs(spaced)).alias("position", "paragraph")
    )


@query(
    "hard_split",
    r"""SELECT doc_id, CAST(i AS INTEGER) AS position,
        array_to_string(w[(i * 461 + 1):(i * 461 + 461)], ' ') AS piece
    FROM (SELECT doc_id, w, unnest(generate_series(0, (len(w) - 1) // 461)) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '\S+') AS w FROM documents) WHERE len(w) > 0)""",
)
def hard_split(spark, sf_dir):
    pieces = chunks.hard_split(F.col("text"), F.lit(chunks.MEDIUM_TOKENS))
    return texts(spark, sf_dir).select(
        "doc_id", F.posexplode(pieces).alias("position", "piece")
    )


@query(
    "token_budget",
    f"""SELECT doc_id, {sql_tokens("w")} AS tokens,
        CAST(CASE WHEN w < 200 THEN 700 WHEN w < 2000 THEN 600 ELSE 700 END AS INTEGER) AS budget
    FROM (SELECT doc_id, {sql_words("text")} AS w FROM documents)""",
)
def token_budget(spark, sf_dir):
    counted = texts(spark, sf_dir).select("doc_id", text.count_words(F.col("text")).alias("w"))
    return counted.select(
        "doc_id",
        text.estimate_tokens(F.col("w")).alias("tokens"),
        chunks.token_budget(F.col("w")).alias("budget"),
    )


# Words looked for in the given documents.
OWN_WORDS = ("the", "nicht", "copyright", "license", "que", "los")


@query(
    "keyword_tags",
    rf"""SELECT doc_id, array_to_string(list_sort(list_distinct(k)), ',') AS keywords, len(k) > 0 AS related
    FROM (SELECT doc_id, regexp_extract_all(regexp_replace(lower(lang || ' ' || text), '([^\p{{L}}\p{{N}}_]+)', '\1\1', 'g'),
        '(?:^|[^\p{{L}}\p{{N}}_])({"|".join(OWN_WORDS)})(?:$|[^\p{{L}}\p{{N}}_])', 1) AS k
        FROM documents)""",
)
def keyword_tags(spark, sf_dir):
    tagged = texts(spark, sf_dir).select(
        "doc_id", cues.matched_keywords(F.col("lang"), F.col("text"), OWN_WORDS).alias("k")
    )
    return tagged.select(
        "doc_id", F.array_join("k", ",").alias("keywords"), (F.size("k") > 0).alias("related")
    )


@query(
    "vtt_clean",
    r"""SELECT doc_id, array_to_string(
        list_transform(list_filter(list_zip(t, generate_series(1, len(t))),
            lambda z: list_position(t, z[1]) = z[2]), lambda z: z[1]), ' ') AS spoken
    FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
            lambda x: trim(x)), lambda x: x <> '') AS t FROM documents)""",
)
def vtt_clean(spark, sf_dir):
    """Every line becomes a cue, said twice and once with tags."""
    lines = F.transform(
        F.split(F.col("text"), "\n"),
        lambda line, i: say(
            i + 1, "\n00:00:01.000 --> 00:00:02.000 align:start\n<c>", line, "</c>\n", line, "\n"
        ),
    )
    file = F.concat(F.lit("WEBVTT\nKind: captions\nLanguage: en\n\n"), F.array_join(lines, "\n"))
    return texts(spark, sf_dir).select("doc_id", cues.clean_cues(file).alias("spoken"))


@query(
    "iso_timestamps",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS utc, strftime(ts, '%Y-%m-%d %H:%M:%S') AS local
    FROM events""",
)
def iso_timestamps(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id", reports.utc_stamp(ts).alias("utc"), reports.local_stamp(ts).alias("local")
    )


def files_of(spark, sf_dir):
    """Article files written from documents; header parts are missing here and there."""
    d, doc = texts(spark, sf_dir), F.col("doc_id")
    folder = say(F.format_string("%02d_", source_number()), "Topic_of_", F.col("source"))
    filename = say(F.format_string("%03d_", doc % 40), "On ", F.col("lang"), "  n.", doc % 7, ".md")
    title = F.when(doc % 7 == 0, "").otherwise(say("  # Title ", doc, " of ", F.col("source"), "\n\n"))
    link = (
        F.when(doc % 5 == 0, "")
        .when(doc % 5 == 1, say("**Source:** http://host.example/x", doc, "\n\n"))
        .otherwise(say("**Source:** [site](http://host.example/", doc, ")\n\n"))
    )
    category = F.when(doc % 4 == 0, "").otherwise(say("**Category:** Topic ", F.col("source"), " \n\n"))
    rule = F.when(doc % 6 == 0, "").otherwise(" ---\n\n")
    raw = F.when(doc % 50 == 49, " \n").otherwise(F.concat(title, link, category, rule, F.col("text")))
    return d.select(
        "doc_id",
        say(folder, "/", F.format_string("%06d_", doc), filename).alias("path"),
        folder.alias("folder"),
        filename.alias("filename"),
        raw.alias("raw"),
    )


FILES = rf"""
    SELECT doc_id, folder || '/' || format('{{:06d}}_', doc_id) || filename AS path, folder, filename,
        CASE WHEN doc_id % 50 = 49 THEN ' ' || chr(10) ELSE t || l || c || r || text END AS raw
    FROM (SELECT doc_id, text,
        format('{{:02d}}_', {SOURCE_NUMBER}) || 'Topic_of_' || source AS folder,
        format('{{:03d}}_', doc_id % 40) || 'On ' || lang || '  n.' || (doc_id % 7) || '.md' AS filename,
        CASE WHEN doc_id % 7 = 0 THEN '' ELSE '  # Title ' || doc_id || ' of ' || source || E'\n\n' END AS t,
        CASE WHEN doc_id % 5 = 0 THEN ''
            WHEN doc_id % 5 = 1 THEN '**Source:** http://host.example/x' || doc_id || E'\n\n'
            ELSE '**Source:** [site](http://host.example/' || doc_id || E')\n\n' END AS l,
        CASE WHEN doc_id % 4 = 0 THEN '' ELSE '**Category:** Topic ' || source || E' \n\n' END AS c,
        CASE WHEN doc_id % 6 = 0 THEN '' ELSE E' ---\n\n' END AS r
    FROM documents)
"""

_LINE = r"(?:^|\n)[ \t\r]*"
_SOURCE_LINE = sql_trim(rf"regexp_extract(raw, '{_LINE}(\*\*Source:\*\*[^\n]*)', 1)")
_BODY = rf"""coalesce(CASE WHEN regexp_matches(raw, '{_LINE}---[ \t\r]*(?:\n|$)') THEN
    {sql_trim(rf"regexp_extract(raw, '(?s)^(?:.*?\n)?[ \t\r]*---[ \t\r]*(?:\n(.*))?$', 1)")} END, {sql_trim("raw")})"""
_HEADING = sql_trim(
    rf"regexp_replace(regexp_extract(raw, '{_LINE}(#[^\n]*)', 1), '^#+\s*', '')"
)
_STEM = r"replace(regexp_replace(regexp_replace(filename, '\.md$', ''), '^\d+_', ''), '_', ' ')"


@query(
    "header_parse",
    rf"""WITH files AS ({FILES})
    SELECT doc_id, coalesce(nullif({_HEADING}, ''), {_STEM}) AS title,
        CASE WHEN regexp_matches({_SOURCE_LINE}, '\([^)]+\)')
            THEN {sql_trim(rf"regexp_extract({_SOURCE_LINE}, '\(([^)]+)\)', 1)")}
            ELSE nullif({sql_trim(rf"regexp_replace({_SOURCE_LINE}, '^\*\*Source:\*\*\s*', '')")}, '')
            END AS source_url,
        {sql_trim(rf"regexp_extract(raw, '{_LINE}\*\*Category:\*\*([^\n]*)', 1)")} AS category_name,
        {_BODY} AS content
    FROM files""",
)
def header_parse(spark, sf_dir):
    raw = F.col("raw")
    return files_of(spark, sf_dir).select(
        "doc_id",
        header.title(raw, F.col("filename")).alias("title"),
        header.source_url(raw).alias("source_url"),
        header.category_name(raw).alias("category_name"),
        header.body(raw).alias("content"),
    )


@query(
    "header_parse_reader",
    rf"""WITH files AS ({FILES})
    SELECT doc_id,
        coalesce(nullif({sql_trim(rf"regexp_extract(raw, '{_LINE}# ([^\n]*\S[^\n]*)', 1)")}, ''), path) AS title,
        CASE WHEN regexp_matches(raw, '\*\*Source:\*\*[ \t\r]*\[[^\n\r]*?\]\([^\n\r]*?\)')
            THEN regexp_extract(raw, '\*\*Source:\*\*[ \t\r]*\[[^\n\r]*?\]\(([^\n\r]*?)\)', 1) END AS source_url,
        {_BODY} AS content
    FROM files""",
)
def header_parse_reader(spark, sf_dir):
    raw = F.col("raw")
    return files_of(spark, sf_dir).select(
        "doc_id",
        header.shown_title(raw, F.col("path")).alias("title"),
        header.shown_source_url(raw).alias("source_url"),
        header.shown_body(raw).alias("content"),
    )


_ARTICLES = rf"""
    files AS ({FILES}),
    parsed AS (SELECT path AS file_path, {sql_words(_BODY, CONTENT_WORD)} AS word_count,
        CAST(regexp_extract(folder, '^(\d+)_', 1) AS INTEGER) AS category_id,
        lower(replace(regexp_replace(folder, '^\d+_', ''), '_', '-')) AS category_slug,
        CAST(regexp_extract(filename, '^(\d+)_', 1) AS INTEGER) AS article_order,
        CAST(regexp_extract(folder, '^(\d+)_', 1) AS INTEGER) || '-' || lower(regexp_replace(regexp_replace(
            regexp_replace(regexp_replace(filename, '^\d+_', ''), '\.md$', ''),
            '[^\w-]', '-', 'g'), '-{{2,}}', '-', 'g')) AS base
        FROM files WHERE regexp_matches(raw, '\S')),
    ranked AS (SELECT *, count(*) OVER (PARTITION BY base) AS members,
        row_number() OVER (PARTITION BY base, article_order ORDER BY file_path) AS nth FROM parsed)"""


@query(
    "articles_table",
    rf"""WITH {_ARTICLES}
    SELECT CASE WHEN members = 1 THEN base ELSE base || '-'
            || CASE WHEN article_order > 0 THEN format('{{:03d}}', article_order) ELSE 'duplicate' END
            || CASE WHEN nth > 1 THEN '-' || nth ELSE '' END END AS slug,
        category_id, category_slug, word_count, file_path, article_order, word_count < 50 AS is_stub
    FROM ranked""",
)
def articles_table(spark, sf_dir):
    return articles.build_articles(files_of(spark, sf_dir)).select(
        "slug", "category_id", "category_slug", "word_count", "file_path", "article_order", "is_stub"
    )


@query(
    "run_summary",
    rf"""WITH {_ARTICLES}
    SELECT (SELECT count(*) FROM files) AS total_files, (SELECT count(*) FROM parsed) AS parsed,
        (SELECT count(*) FROM files) - (SELECT count(*) FROM parsed) AS skipped_empty,
        (SELECT count(*) FROM parsed WHERE word_count < 50) AS stubs""",
)
def run_summary(spark, sf_dir):
    files = files_of(spark, sf_dir)
    return articles.ingest_summary(files, articles.parse_files(files))


def categories_of(spark, sf_dir):
    """Category table from the sources of the documents."""
    return (
        documents(spark, sf_dir)
        .select(source_number().alias("id"), F.concat(F.lit("topic-"), "source").alias("slug"), "source")
        .distinct()
        .select("id", "slug", F.concat(F.lit("Topic "), "source").alias("name"))
    )


def local_articles(spark, sf_dir):
    """Documents as the reader's articles."""
    doc = F.col("doc_id")
    return texts(spark, sf_dir).select(
        doc.cast("string").alias("id"),
        say("doc-", doc).alias("slug"),
        say("Document ", doc).alias("title"),
        source_number().alias("category_id"),
        say("Topic ", F.col("source")).alias("category_name"),
        say("topic-", F.col("source")).alias("category_slug"),
        F.lit(None).cast("string").alias("source_url"),
        text.count_words(F.col("text")).alias("word_count"),
        doc.cast("int").alias("article_order"),
        F.col("text").alias("content"),
    )


_SUMMARY_SQL = f"""SELECT CAST(doc_id AS VARCHAR) AS id, 'doc-' || doc_id AS slug, 'Document ' || doc_id AS title,
        {SOURCE_NUMBER} AS category_id, 'Topic ' || source AS category_name,
        'topic-' || source AS category_slug, CAST(NULL AS VARCHAR) AS source_url,
        {sql_words("text")} AS word_count, CAST(doc_id AS INTEGER) AS article_order,
        {sql_excerpt("plain")} AS excerpt
    FROM (SELECT *, {sql_plain("text")} AS plain FROM documents)"""


@query("article_summaries", _SUMMARY_SQL)
def article_summaries(spark, sf_dir):
    return articles.summaries(local_articles(spark, sf_dir))


@query("article_summary_by_category", f"SELECT * FROM ({_SUMMARY_SQL}) WHERE category_id = 3")
def article_summary_by_category(spark, sf_dir):
    return articles.summaries(local_articles(spark, sf_dir), 3)


@query(
    "category_distribution",
    f"""SELECT {SOURCE_NUMBER} AS category_id, min('Topic ' || source) AS category_name, count(*) AS articles
    FROM documents GROUP BY 1""",
)
def category_distribution(spark, sf_dir):
    return articles.category_distribution(local_articles(spark, sf_dir))


@query(
    "reader_articles",
    rf"""WITH files AS ({FILES}), shown AS (
        SELECT path AS file_path, {sql_words("raw")} AS word_count,
            CAST(regexp_extract(folder, '^(\d+)_', 1) AS INTEGER) AS category_id,
            CAST(regexp_extract(filename, '^(\d+)_', 1) AS INTEGER) AS article_order,
            CAST(regexp_extract(folder, '^(\d+)_', 1) AS INTEGER) || '-' || lower(regexp_replace(regexp_replace(
                regexp_replace(regexp_replace(filename, '^\d+_', ''), '\.md$', ''),
                '[^\w-]', '-', 'g'), '-{{2,}}', '-', 'g')) AS base FROM files),
    ranked AS (SELECT *, count(*) OVER (PARTITION BY base) AS members,
        row_number() OVER (PARTITION BY base, article_order ORDER BY file_path) AS nth FROM shown),
    dim AS (SELECT DISTINCT {SOURCE_NUMBER} AS category_id, 'Topic ' || source AS category_name,
        'topic-' || source AS category_slug FROM documents)
    SELECT CASE WHEN members = 1 THEN base ELSE base || '-'
            || CASE WHEN article_order > 0 THEN format('{{:03d}}', article_order) ELSE 'duplicate' END
            || CASE WHEN nth > 1 THEN '-' || nth ELSE '' END END AS slug,
        category_id, category_name, category_slug, word_count, article_order
    FROM ranked JOIN dim USING (category_id)""",
)
def reader_articles(spark, sf_dir):
    return articles.load_local(files_of(spark, sf_dir), categories_of(spark, sf_dir)).select(
        "slug", "category_id", "category_name", "category_slug", "word_count", "article_order"
    )
