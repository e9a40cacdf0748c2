"""Keyed tables: repeats, merges, differences and increments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import incremental, keyed, ranking
from ..sources import tables
from .base import documents, query, say, table


def url_variants(spark, sf_dir):
    """Page URLs with a slash and in capitals as well, in three groups."""
    pages, url, at = table(spark, sf_dir, "pages"), F.col("url"), F.col("page_id")

    def group(name, form):
        return pages.select(F.lit(name).alias("folder"), at.alias("position"), form.alias("url"))

    both = group("1_plain", url).union(group("2_slash", say(url, "/"))).union(
        group("3_capitals", F.upper(url))
    )
    return both.withColumn("url_key", names.url_key(F.col("url")))


_VARIANTS = r"""variants AS (
    SELECT *, lower(regexp_replace(url, '/+$', '')) AS url_key FROM (
        SELECT '1_plain' AS folder, page_id AS position, url FROM pages
        UNION ALL SELECT '2_slash', page_id, url || '/' FROM pages
        UNION ALL SELECT '3_capitals', page_id, upper(url) FROM pages)),
    firsts AS (SELECT * FROM variants
        QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY folder, position) = 1)"""


@query("url_first_dedup", f"WITH {_VARIANTS} SELECT folder, position, url FROM firsts")
def url_first_dedup(spark, sf_dir):
    return keyed.first_per_key(
        url_variants(spark, sf_dir), ["url_key"], ["folder", "position"]
    ).select("folder", "position", "url")


@query(
    "url_dups_per_group",
    f"""WITH {_VARIANTS}
    SELECT folder, count(*) AS total, count(f) AS kept, count(*) - count(f) AS removed
    FROM variants LEFT JOIN (SELECT folder, position, 1 AS f FROM firsts) USING (folder, position)
    GROUP BY folder""",
)
def url_dups_per_group(spark, sf_dir):
    return keyed.removed_per_group(
        url_variants(spark, sf_dir), "folder", ["url_key"], ["folder", "position"]
    )


def _slugs(df, key, prefix):
    return df.select(say(prefix, F.format_string("%09d", F.col(key))).alias("slug"))


@query(
    "set_diff_audit",
    """SELECT format('d{:09d}', doc_id) AS slug, 'left' AS side
        FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
    UNION ALL SELECT format('d{:09d}', doc_id), 'right'
        FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)""",
)
def set_diff_audit(spark, sf_dir):
    return keyed.one_sided(
        _slugs(documents(spark, sf_dir), "doc_id", "d"),
        _slugs(table(spark, sf_dir, "labels"), "doc_id", "d"),
        "slug",
    )


@query(
    "set_diff_users",
    """SELECT * FROM (SELECT user_id AS id, 'left' AS side FROM events
        EXCEPT SELECT c_custkey, 'left' FROM customer)
    UNION ALL SELECT * FROM (SELECT c_custkey, 'right' FROM customer
        EXCEPT SELECT user_id, 'right' FROM events)""",
)
def set_diff_users(spark, sf_dir):
    return keyed.one_sided(
        table(spark, sf_dir, "events").select(F.col("user_id").alias("id")),
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")),
        "id",
    )


@query("missing_children", "SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)")
def missing_children(spark, sf_dir):
    return keyed.absent_rows(
        documents(spark, sf_dir).select("doc_id", "source"),
        table(spark, sf_dir, "labels"),
        ["doc_id"],
    )


@query("present_children", "SELECT doc_id, source FROM documents SEMI JOIN labels USING (doc_id)")
def present_children(spark, sf_dir):
    return keyed.present_rows(
        documents(spark, sf_dir).select("doc_id", "source"),
        table(spark, sf_dir, "labels"),
        ["doc_id"],
    )


def _videos(events):
    """Events as videos: one URL per user, kind and number."""
    k = F.get_json_object("props", "$.k")
    return events.select(
        say("u", F.col("user_id"), "/", F.col("event_type"), "/", k).alias("video_url"),
        F.col("event_id"),
        F.date_format("ts", "yyyyMMdd").alias("upload_date"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("scraped_at"),
        "value",
    )


_SPLIT = "2024-01-16 00:00:00"
_URL = "'u' || user_id || '/' || event_type || '/' || json_extract_string(props, '$.k')"
_VIDEOS = f"""v AS (SELECT {_URL} AS video_url, event_id, ts, value,
        strftime(ts, '%Y%m%d') AS upload_date, ts < TIMESTAMP '{_SPLIT}' AS old FROM events)"""


def _old_new(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    before = F.col("ts") < F.lit(_SPLIT).cast("timestamp_ntz")
    return _videos(events.where(before)), _videos(events.where(~before))


@query(
    "incremental_new_rows",
    f"""WITH {_VIDEOS} SELECT event_id, video_url FROM v WHERE NOT old
        AND video_url NOT IN (SELECT video_url FROM v WHERE old)""",
)
def incremental_new_rows(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return incremental.new_videos(new, old).select("event_id", "video_url")


@query(
    "keyed_merge_latest",
    f"""WITH {_VIDEOS} SELECT video_url, event_id, upload_date, value FROM v
    QUALIFY row_number() OVER (PARTITION BY video_url ORDER BY old, ts DESC, event_id DESC) = 1""",
)
def keyed_merge_latest(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return keyed.merge_by_key(old, new, ["video_url"], ["scraped_at", "event_id"]).select(
        "video_url", "event_id", "upload_date", "value"
    )


@query(
    "insert_ignore_merge",
    f"""WITH {_VIDEOS} SELECT video_url, event_id FROM v
    WHERE NOT old AND video_url NOT IN (SELECT video_url FROM v WHERE old)
    QUALIFY row_number() OVER (PARTITION BY video_url ORDER BY ts, event_id) = 1""",
)
def insert_ignore_merge(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return keyed.insert_missing(old, new, ["video_url"], ["scraped_at", "event_id"]).select(
        "video_url", "event_id"
    )


@query(
    "unvisited_posts",
    f"""WITH {_VIDEOS} SELECT DISTINCT video_url AS url FROM v
    WHERE NOT old AND video_url NOT IN (SELECT video_url FROM v WHERE old)""",
)
def unvisited_posts(spark, sf_dir):
    old, new = (df.select(F.col("video_url").alias("url")) for df in _old_new(spark, sf_dir))
    return incremental.unvisited(new, old)


@query(
    "union_state",
    f"SELECT DISTINCT {_URL} AS url FROM events",
)
def union_state(spark, sf_dir):
    old, new = (df.select(F.col("video_url").alias("url")) for df in _old_new(spark, sf_dir))
    return incremental.visited_after(old, new)


@query(
    "union_groups",
    """SELECT 'documents' AS folder, doc_id AS position FROM documents
    UNION ALL SELECT 'labels', doc_id FROM labels""",
)
def union_groups(spark, sf_dir):
    first = documents(spark, sf_dir).select(
        F.lit("documents").alias("folder"), F.col("doc_id").alias("position")
    )
    second = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("position"), F.lit("labels").alias("folder")
    )
    return first.unionByName(second)


@query(
    "batch_numbering",
    """SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 20 AS batch FROM events""",
)
def batch_numbering(spark, sf_dir):
    return ranking.batches(
        table(spark, sf_dir, "events").select("ts", "event_id"), ["ts", "event_id"], 20
    ).select("event_id", "batch")


@query(
    "position_in_category",
    """SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS position
    FROM documents""",
)
def position_in_category(spark, sf_dir):
    return ranking.numbered(documents(spark, sf_dir).select("doc_id", "source"), ["source"], ["doc_id"])


@query(
    "continued_numbering",
    """SELECT doc_id, row_number() OVER (ORDER BY doc_id) + (SELECT count(*) FROM labels) AS number
    FROM documents ANTI JOIN labels USING (doc_id)""",
)
def continued_numbering(spark, sf_dir):
    stored = table(spark, sf_dir, "labels")
    fresh = keyed.absent_rows(documents(spark, sf_dir).select("doc_id"), stored, ["doc_id"])
    existing = stored.count()
    return ranking.numbered(fresh, [], ["doc_id"], "number").withColumn(
        "number", F.col("number") + existing
    )


@query(
    "distinct_vs_total",
    """SELECT count(text) AS total, count(DISTINCT text) AS distinct_texts,
        count(text) - count(DISTINCT text) AS repeats FROM documents""",
)
def distinct_vs_total(spark, sf_dir):
    # Texts are compared by a strong hash, so the shuffle carries 32 bytes each.
    hashed = documents(spark, sf_dir).select(F.unhex(F.sha2("text", 256)).alias("h"))
    return hashed.agg(
        F.count("h").alias("total"), F.count_distinct("h").alias("distinct_texts")
    ).withColumn("repeats", F.col("total") - F.col("distinct_texts"))


@query("distinct_groups", "SELECT DISTINCT source, lang FROM documents")
def distinct_groups(spark, sf_dir):
    return documents(spark, sf_dir).select("source", "lang").distinct()


@query("distinct_group_count", "SELECT count(DISTINCT source) AS sources FROM documents")
def distinct_group_count(spark, sf_dir):
    return documents(spark, sf_dir).agg(F.count_distinct("source").alias("sources"))


@query(
    "lookup_by_keys",
    """SELECT c_custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def lookup_by_keys(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return tables.by_keys(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name"),
        "c_custkey",
        urgent.select(F.col("o_custkey").alias("c_custkey")),
    )


@query(
    "lookup_by_slug",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name = 'Customer#000000042'",
)
def lookup_by_slug(spark, sf_dir):
    return tables.by_key(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"),
        "c_name",
        "Customer#000000042",
    )


@query(
    "known_group",
    """SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def known_group(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, "c_nationkey")
        .select("c_custkey", "n_name")
    )


@query("non_stub_filter", "SELECT doc_id FROM documents WHERE NOT (n_chars < 300)")
def non_stub_filter(spark, sf_dir):
    stubs = documents(spark, sf_dir).select("doc_id", (F.col("n_chars") < 300).alias("is_stub"))
    return stubs.where(~F.col("is_stub")).select("doc_id")


@query(
    "filtered_counts",
    """SELECT count(*) AS customers, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building,
        count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment = '') AS unnamed,
        count(*) FILTER (WHERE c_nationkey < 1 OR c_nationkey > 20) AS outside,
        count(*) FILTER (WHERE c_acctbal < 0) AS in_debt,
        count(*) FILTER (WHERE c_name IS NOT NULL) AS named FROM customer""",
)
def filtered_counts(spark, sf_dir):
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    return table(spark, sf_dir, "customer").agg(
        F.count("*").alias("customers"),
        F.count_if(segment == "BUILDING").alias("building"),
        F.count_if(segment.isNull() | (segment == "")).alias("unnamed"),
        F.count_if((nation < 1) | (nation > 20)).alias("outside"),
        F.count_if(F.col("c_acctbal") < 0).alias("in_debt"),
        F.count_if(F.col("c_name").isNotNull()).alias("named"),
    )


@query(
    "coalesced_sum",
    """SELECT user_id, CAST(sum(coalesce(CAST(nullif(json_extract_string(props, '$.k'), '50') AS BIGINT), 1)) AS BIGINT)
        AS citations, count(*) AS rows FROM events GROUP BY user_id""",
)
def coalesced_sum(spark, sf_dir):
    k = F.nullif(F.get_json_object("props", "$.k"), F.lit("50")).cast("bigint")
    return (
        table(spark, sf_dir, "events")
        .select("user_id", k.alias("k"))
        .groupBy("user_id")
        .agg(F.sum(F.coalesce("k", F.lit(1))).alias("citations"), F.count("*").alias("rows"))
    )
