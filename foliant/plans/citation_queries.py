"""Citation queries; the texts are written from order and line-item keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import citations as cite
from ..operators import citation_index as index
from ..operators import quality
from ..sources.tables import spread
from .base import query, say, table

# Short forms that the order texts rotate through; some are no citations at all.
ROTATION = (
    "1 Cor.", "Ps", "II John", "Gen.", "Song of Songs", "1John", "1st John", "Rev.",
    "Is", "1 Thess", "Jude", "Quran",
)


def lineitem_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One short text per line item; surahs above 114 and ayahs above 300 occur."""
    part = F.col("l_partkey") % 310
    end = F.when(F.col("l_linenumber") % 3 == 0, say("-", part + 3)).otherwise("")
    text = say("see S. ", F.col("l_orderkey") % 120 + 1, ":", part + 1, end, " and others.")
    items = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    return items.select(F.col("l_orderkey").alias("id"), text.alias("content"))


LINEITEM_TEXTS = """
    SELECT l_orderkey AS id,
        'see S. ' || (l_orderkey % 120 + 1) || ':' || (l_partkey % 310 + 1)
        || CASE WHEN l_linenumber % 3 = 0 THEN '-' || (l_partkey % 310 + 3) ELSE '' END
        || ' and others.' AS content
    FROM lineitem
"""


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text per order with a Bible citation and, for many, a Quran citation."""
    name = F.element_at(
        F.array(*[F.lit(n) for n in ROTATION]), (F.col("o_orderkey") % len(ROTATION) + 1).cast("int")
    )
    verse = F.col("o_custkey") % 31 + 1
    end = F.when(F.col("o_orderkey") % 4 == 0, say("-", verse + 2)).otherwise("")
    text = say(
        "Compare ", name, " ", F.col("o_orderkey") % 50 + 1, ":", verse, end,
        "; Q", F.col("o_custkey") % 130, ":", F.col("o_orderkey") % 20, ".",
    )
    orders = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    return orders.select(F.col("o_custkey").alias("id"), text.alias("content"))


_ROTATION_SQL = ", ".join(f"'{n}'" for n in ROTATION)
ORDER_TEXTS = f"""
    SELECT o_custkey AS id,
        'Compare ' || [{_ROTATION_SQL}][o_orderkey % {len(ROTATION)} + 1]
        || ' ' || (o_orderkey % 50 + 1) || ':' || (o_custkey % 31 + 1)
        || CASE WHEN o_orderkey % 4 = 0 THEN '-' || (o_custkey % 31 + 3) ELSE '' END
        || '; Q' || (o_custkey % 130) || ':' || (o_orderkey % 20) || '.' AS content
    FROM orders
"""


def _bible_tokens() -> dict[str, str]:
    return {**{b: b for b in cite.testaments()}, **cite.short_forms()}


def _sql_token_rows() -> str:
    where = cite.testaments()
    return ", ".join(f"('{t}', '{b}', '{where[b]}')" for t, b in _bible_tokens().items())


def citations_sql(texts: str) -> str:
    """All citations of a text table, with expressions DuckDB's patterns can hold.

    The boundary before a citation is matched instead of looked at.
    """
    tokens = "|".join(
        t.replace(".", r"\.") for t in sorted(_bible_tokens(), key=lambda t: (-len(t), t))
    )
    bible = rf"(?:^|\W)(?:{tokens})(?:\.\s*|\s+)\d{{1,3}}:\d{{1,3}}(?:-\d{{1,3}})?"
    quran = r"(?:^|[^A-Za-z])[SQ]\.?\s{0,2}\d{1,3}:\d{1,3}(?:-\d{1,3})?"
    numbers = r"(\d{1,3}):(\d{1,3})(?:-(\d{1,3}))?$"
    return rf"""
    texts AS ({texts}),
    tokens(token, book, testament) AS (VALUES {_sql_token_rows()}),
    found AS (
        SELECT id, 'bible' AS scheme, unnest(regexp_extract_all(content, '{bible}')) AS m FROM texts
        UNION ALL
        SELECT id, 'quran', unnest(regexp_extract_all(content, '{quran}')) FROM texts
    ),
    parsed AS (
        SELECT id, scheme,
            regexp_replace(regexp_replace(m, '^\W', ''), '\.*\s*\d{{1,3}}:[\d-]+$', '') AS token,
            CAST(regexp_extract(m, '{numbers}', 1) AS INTEGER) AS chapter,
            CAST(regexp_extract(m, '{numbers}', 2) AS INTEGER) AS verse_start,
            CAST(nullif(regexp_extract(m, '{numbers}', 3), '') AS INTEGER) AS verse_end
        FROM found
    ),
    citations AS (
        SELECT p.id AS article_id, p.scheme, coalesce(t.book, 'S.') AS book, t.testament,
            p.chapter, p.verse_start, p.verse_end,
            coalesce(t.book, 'S.') || ' ' || p.chapter || ':' || p.verse_start
                || coalesce('-' || p.verse_end, '') AS reference,
            CASE WHEN p.scheme = 'bible' THEN t.book || '|' ELSE '' END
                || p.chapter || '|' || p.verse_start || '|'
                || coalesce(CAST(p.verse_end AS VARCHAR), 'null') AS verse_key
        FROM parsed p LEFT JOIN tokens t ON p.scheme = 'bible' AND p.token = t.token
        WHERE (p.scheme = 'bible' AND t.book IS NOT NULL)
            OR (p.scheme = 'quran' AND p.chapter BETWEEN 1 AND 114 AND p.verse_start BETWEEN 1 AND 300
                AND (p.verse_end IS NULL OR (p.verse_end >= p.verse_start AND p.verse_end <= 300)))
    ),
    junction AS (
        SELECT article_id, scheme, book, testament, chapter, verse_start, verse_end, reference,
            verse_key, CAST(count(*) AS INTEGER) AS occurrence_count
        FROM citations GROUP BY ALL
    ),
    verses AS (
        SELECT DISTINCT sha256(scheme || '|' || verse_key) AS id, scheme, book, testament, chapter,
            verse_start, verse_end, reference, verse_key FROM junction
    )"""


def _junction(texts: DataFrame) -> DataFrame:
    return index.count_per_article(index.extract_citations(texts))


@query(
    "citation_top10",
    f"""WITH {citations_sql(LINEITEM_TEXTS)}
    SELECT reference, CAST(sum(occurrence_count) AS BIGINT) AS total_occurrences,
        count(*) AS article_count
    FROM junction GROUP BY reference, verse_key
    ORDER BY total_occurrences DESC, verse_key LIMIT 10""",
)
def citation_top10(spark, sf_dir):
    return index.top_verses(_junction(lineitem_texts(spark, sf_dir)))


@query(
    "citation_bible_index",
    f"""WITH {citations_sql(ORDER_TEXTS)}
    SELECT article_id, scheme, testament, reference, verse_key, occurrence_count FROM junction""",
)
def citation_bible_index(spark, sf_dir):
    return _junction(order_texts(spark, sf_dir)).select(
        "article_id", "scheme", "testament", "reference", "verse_key", "occurrence_count"
    )


@query(
    "verse_dim_distinct",
    f"""WITH {citations_sql(LINEITEM_TEXTS)}
    SELECT id, chapter AS surah, verse_start AS ayah_start, verse_end AS ayah_end, reference,
        CAST(NULL AS VARCHAR) AS surah_name FROM verses""",
)
def verse_dim_distinct(spark, sf_dir):
    return index.quran_verses(index.verse_table(_junction(lineitem_texts(spark, sf_dir))))


@query(
    "bible_verse_dim",
    f"""WITH {citations_sql(ORDER_TEXTS)}
    SELECT id, book, chapter, verse_start, verse_end, reference, testament
    FROM verses WHERE scheme = 'bible'""",
)
def bible_verse_dim(spark, sf_dir):
    return index.bible_verses(index.verse_table(_junction(order_texts(spark, sf_dir))))


def _sides_sql(select: str) -> str:
    """Junction of the orders against the verse table of the line items."""
    left = citations_sql(ORDER_TEXTS).replace("junction AS", "left_junction AS").replace(
        "FROM junction", "FROM left_junction"
    )
    return f"""WITH l AS (WITH {left} SELECT * FROM left_junction),
    r AS (WITH {citations_sql(LINEITEM_TEXTS)} SELECT * FROM verses)
    {select}"""


def _sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return (
        _junction(order_texts(spark, sf_dir)),
        index.verse_table(_junction(lineitem_texts(spark, sf_dir))),
    )


@query(
    "verse_junction_links",
    _sides_sql(
        """SELECT l.article_id, r.id AS verse_id, l.occurrence_count
        FROM l JOIN r ON l.scheme = r.scheme AND l.verse_key = r.verse_key"""
    ),
)
def verse_junction_links(spark, sf_dir):
    return index.link_verses(*_sides(spark, sf_dir))[0]


@query(
    "verse_junction_rejects",
    _sides_sql(
        """SELECT l.article_id, l.scheme, l.verse_key FROM l
        ANTI JOIN r ON l.scheme = r.scheme AND l.verse_key = r.verse_key"""
    ),
)
def verse_junction_rejects(spark, sf_dir):
    return index.link_verses(*_sides(spark, sf_dir))[1]


_REJECTS = "FROM l ANTI JOIN r ON l.scheme = r.scheme AND l.verse_key = r.verse_key"


@query(
    "citation_run_report",
    _sides_sql(
        f"""SELECT (SELECT count(*) FROM orders) AS articles_processed,
        (SELECT count(DISTINCT article_id) FROM l) AS articles_with_citations,
        (SELECT count(DISTINCT l.article_id) {_REJECTS}) AS articles_failed,
        (SELECT count(*) {_REJECTS}) AS rows_rejected"""
    ),
)
def citation_run_report(spark, sf_dir):
    junction, verses = _sides(spark, sf_dir)
    articles = table(spark, sf_dir, "orders").select("o_orderkey")
    return index.run_report(articles, junction, index.link_verses(junction, verses)[1])


@query(
    "citation_warnings",
    _sides_sql(
        f"""(SELECT 0 AS place, 'article ' || l.article_id || ': no ' || l.scheme || ' verse ' || l.verse_key AS warning
            {_REJECTS} ORDER BY l.article_id, l.scheme, l.verse_key LIMIT 20)
        UNION ALL (SELECT 1, 'and ' || (count(*) - 20) || ' more' {_REJECTS} HAVING count(*) > 20)"""
    ),
)
def citation_warnings(spark, sf_dir):
    return index.warnings(index.link_verses(*_sides(spark, sf_dir))[1])


@query(
    "orphan_verses",
    _sides_sql(
        """SELECT r.id, r.reference FROM r
        ANTI JOIN l ON l.scheme = r.scheme AND l.verse_key = r.verse_key"""
    ),
)
def orphan_verses(spark, sf_dir):
    junction, verses = _sides(spark, sf_dir)
    # Ids follow from the keys, so the links need no join.
    links = junction.select(cite.verse_id(F.col("scheme"), F.col("verse_key")).alias("verse_id"))
    return quality.orphan_verses(verses, links).select("id", "reference")


@query(
    "quran_bounds_reject",
    rf"""WITH texts AS ({LINEITEM_TEXTS}),
    found AS (SELECT unnest(regexp_extract_all(content,
        '(?:^|[^A-Za-z])[SQ]\.?\s{{0,2}}\d{{1,3}}:\d{{1,3}}(?:-\d{{1,3}})?')) AS m FROM texts),
    parsed AS (SELECT
        CAST(regexp_extract(m, '(\d{{1,3}}):', 1) AS INTEGER) AS surah,
        CAST(regexp_extract(m, ':(\d{{1,3}})', 1) AS INTEGER) AS s,
        CAST(nullif(regexp_extract(m, '-(\d{{1,3}})', 1), '') AS INTEGER) AS e FROM found)
    SELECT surah, count(*) FILTER (WHERE ok) AS accepted, count(*) FILTER (WHERE NOT ok) AS rejected
    FROM (SELECT surah, surah BETWEEN 1 AND 114 AND s BETWEEN 1 AND 300
        AND (e IS NULL OR (e >= s AND e <= 300)) AS ok FROM parsed) GROUP BY surah""",
)
def quran_bounds_reject(spark, sf_dir):
    texts = lineitem_texts(spark, sf_dir)
    found = texts.select(F.explode(cite.cited_quran(F.col("content"))).alias("m"))
    surah, start, end = cite.numbers_of(F.col("m"))
    parsed = found.select(surah.alias("surah"), start.alias("s"), end.alias("e"))
    ok = cite.quran_in_bounds(F.col("surah"), F.col("s"), F.col("e"))
    return (
        parsed.withColumn("ok", ok)
        .groupBy("surah")
        .agg(F.count_if("ok").alias("accepted"), F.count_if(~F.col("ok")).alias("rejected"))
    )


@query(
    "citation_summary",
    f"""WITH {citations_sql(ORDER_TEXTS)}
    SELECT scheme, CAST(sum(occurrence_count) AS BIGINT) AS refs_found,
        count(DISTINCT verse_key) AS unique_verses, count(*) AS junction_rows
    FROM junction GROUP BY scheme""",
)
def citation_summary(spark, sf_dir):
    return index.index_summary(_junction(order_texts(spark, sf_dir)))


@query(
    "top_label_enrich",
    """WITH totals AS (
        SELECT CAST(l_partkey AS VARCHAR) AS verse_id, CAST(sum(coalesce(l_linenumber, 1)) AS BIGINT) AS citations
        FROM lineitem GROUP BY 1 ORDER BY citations DESC, verse_id LIMIT 10)
    SELECT coalesce(s_name || ' (' || nullif(CAST(s_nationkey AS VARCHAR), '') || ')', verse_id) AS label, citations
    FROM totals LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = verse_id""",
)
def top_label_enrich(spark, sf_dir):
    linked = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("verse_id"),
        F.col("l_linenumber").alias("occurrence_count"),
    )
    verses = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("reference"),
        F.col("s_nationkey").cast("string").alias("surah_name"),
    )
    return index.top_linked(linked, verses)
