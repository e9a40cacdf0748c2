"""Index documents, ordered lists and JSON records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cues, names
from ..operators import quality, ranking
from ..sinks import reports
from ..sources import tables, videos
from .base import SOURCE_NUMBER, documents, query, say, source_number, table


def links_of(spark, sf_dir):
    """Documents as index links of their source's folder; some failed."""
    doc = F.col("doc_id")
    title = say("Report ", doc, ": ", F.col("lang"))
    return documents(spark, sf_dir).select(
        say(F.format_string("%02d_", source_number()), "topic_of_", F.col("source")).alias("folder"),
        doc.alias("position"),
        title.alias("title"),
        say("https://host.example/", doc).alias("url"),
        names.safe_filename(title).alias("filename"),
        (doc % 9 == 0).alias("failed"),
    )


_LINKS = rf"""links AS (SELECT format('{{:02d}}_', {SOURCE_NUMBER}) || 'topic_of_' || source AS folder,
        'Topic Of Src' || regexp_extract(source, '(\d+)$', 1) AS shown, doc_id,
        'Report ' || doc_id || ': ' || lang AS title, 'https://host.example/' || doc_id AS url,
        'report_' || doc_id || '_' || lang AS filename, doc_id % 9 = 0 AS failed,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n,
        count(*) OVER (PARTITION BY source) AS total FROM documents)"""


@query(
    "index_markdown",
    f"""WITH {_LINKS}
    SELECT folder, n AS line_no, n || '. ' || CASE WHEN failed THEN '[FAILED] ' || title || ' - ' || url
        ELSE '[' || title || '](' || filename || ')' END AS line FROM links
    UNION ALL SELECT folder, -3, '# ' || shown FROM links WHERE n = 1
    UNION ALL SELECT folder, -2, '' FROM links WHERE n = 1
    UNION ALL SELECT folder, -1, 'Total articles: ' || total FROM links WHERE n = 1
    UNION ALL SELECT folder, 0, '' FROM links WHERE n = 1""",
)
def index_markdown(spark, sf_dir):
    return reports.category_index(links_of(spark, sf_dir))


@query(
    "master_index",
    f"""WITH {_LINKS}
    SELECT '' AS folder, CAST(unnest(generate_series(-9, 0)) AS BIGINT) AS line_no, unnest(['# All Reports', '',
        'Source: host.example', '', '---', '', '## Table of Contents', '', '**Total: '
        || (SELECT count(*) FROM links) || ' articles across '
        || (SELECT count(DISTINCT folder) FROM links) || ' categories**', '']) AS line
    UNION ALL SELECT folder, n, '  ' || n || '. [' || title || '](' || folder || '/' || format('{{:03d}}_', n)
        || filename || '.md)' FROM links
    UNION ALL SELECT folder, -2, '### [' || shown || '](' || folder || '/00_INDEX.md)' FROM links WHERE n = 1
    UNION ALL SELECT folder, -1, '*' || total || ' articles*' FROM links WHERE n = 1
    UNION ALL SELECT folder, 0, '' FROM links WHERE n = 1
    UNION ALL SELECT folder, total + 1, '' FROM links WHERE n = 1""",
)
def master_index(spark, sf_dir):
    return reports.master_index(links_of(spark, sf_dir), "All Reports", "host.example")


@query(
    "group_count_map",
    f"""SELECT category, articles, CAST(sum(articles) OVER () AS BIGINT) AS total
    FROM (SELECT {SOURCE_NUMBER} AS category, count(*) AS articles FROM documents GROUP BY 1)""",
)
def group_count_map(spark, sf_dir):
    links = documents(spark, sf_dir).select(source_number().alias("folder"))
    counted = reports.counts_per_category(links, links.distinct())
    return counted.select(F.col("folder").alias("category"), F.col("n").alias("articles"), "total")


@query(
    "newest_first",
    """SELECT event_id, row_number() OVER (ORDER BY strftime(ts, '%Y%m%d') DESC, event_id DESC) AS place
    FROM events""",
)
def newest_first(spark, sf_dir):
    dated = table(spark, sf_dir, "events").select(
        "event_id", F.coalesce(F.date_format("ts", "yyyyMMdd"), F.lit("")).alias("upload_date")
    )
    return ranking.numbered(dated, [], ["upload_date", "event_id"], "place", descending=True).select(
        "event_id", "place"
    )


@query(
    "restore_order",
    """SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place
    FROM conversations""",
)
def restore_order(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return ranking.numbered(turns, ["conv_id"], ["turn"], "place")


@query(
    "ordered_samples",
    """SELECT event_id, value FROM events WHERE value IS NOT NULL ORDER BY event_id LIMIT 5""",
)
def ordered_samples(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return events.where(F.col("value").isNotNull()).orderBy("event_id").limit(5)


@query(
    "capped_list",
    """SELECT doc_id AS id, greatest((SELECT count(*) FROM documents ANTI JOIN labels USING (doc_id)) - 10, 0) AS more
    FROM documents ANTI JOIN labels USING (doc_id) ORDER BY doc_id LIMIT 10""",
)
def capped_list(spark, sf_dir):
    articles = documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.lit(False).alias("is_stub")
    )
    chunks = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("article_id"))
    return quality.first_missing(quality.missing_chunks(articles, chunks))


@query(
    "first_slugs",
    """SELECT format('d{:09d}', doc_id) AS slug FROM documents ANTI JOIN labels USING (doc_id)
    ORDER BY doc_id LIMIT 20""",
)
def first_slugs(spark, sf_dir):
    only = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")
    return quality.first_slugs(only.select(say("d", F.format_string("%09d", "doc_id")).alias("slug")))


@query("page_slice", "SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 50 OFFSET 100")
def page_slice(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return tables.page(events, ["ts", "event_id"], 100, 50)


@query(
    "json_records",
    """SELECT event_id, CASE WHEN k % 3 = 0 THEN 'https://www.youtube.com/watch?v=v' || event_id
            ELSE 'https://v.example/' || k END AS video_url, CAST(k AS DOUBLE) AS duration
    FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def json_records(spark, sf_dir):
    k = F.from_json("props", "k bigint")["k"]
    entries = table(spark, sf_dir, "events").select(
        "event_id",
        say("v", F.col("event_id")).alias("id"),
        say("Video ", k).alias("title"),
        F.when(k % 3 == 0, "").otherwise(say("https://v.example/", k)).alias("url"),
        k.cast("double").alias("duration"),
    )
    return videos.listed_videos(entries).select(
        F.expr("cast(substr(id, 2) as bigint)").alias("event_id"), "video_url", "duration"
    )


@query(
    "subtitle_tracks",
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN 'm/vtt'
        WHEN event_id % 4 = 2 THEN 'a/srv1' ELSE 'a/first' END AS track FROM events""",
)
def subtitle_tracks(spark, sf_dir):
    kind = F.col("event_id") % 4
    tracks = "map<string, array<struct<ext: string, url: string>>>"

    def listed(*formats):
        return F.array(*[F.struct(F.lit(e).alias("ext"), F.lit(u).alias("url")) for e, u in formats])

    def language(name, formats):
        return F.create_map(F.lit(name), formats).cast(tracks)

    manual = F.when(kind == 1, language("en", listed(("ttml", "m/ttml"), ("vtt", "m/vtt")))).otherwise(
        language("de", listed(("vtt", "m/de")))
    )
    automatic = (
        F.when(kind == 2, language("en", listed(("ttml", "a/ttml"), ("srv1", "a/srv1"))))
        .when(kind == 3, language("en", listed(("x", "a/first"), ("y", "a/second"))))
        .otherwise(language("fr", listed(("vtt", "a/fr"))))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", cues.subtitle_url(manual, automatic).alias("track")
    )
