"""Slugs, file names, display names and URLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import collisions
from .base import SOURCE_NUMBER, documents, query, say, source_number, sql_trim, table

# Hosts and sites as a caller would configure them.
KNOWN_HOSTS = ("example.com", "example.org")
SITES = {"blog.": "Blog", "spam-farm": "Spam Farm", "m.th": "Mobile"}

_PART_FILE = "format('{:03d}_', p_partkey % 50) || p_name || ' & ' || p_brand || '.MD'"
_SLUG = r"""lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(f, '^\d+_', ''),
    '(?i)\.md$', ''), '[^\w-]', '-', 'g'), '-{2,}', '-', 'g'))"""


def part_files(spark, sf_dir):
    """File names from parts; brands and names repeat, so slugs collide."""
    name = say(
        F.format_string("%03d_", F.col("p_partkey") % 50), F.col("p_name"), " & ", F.col("p_brand"), ".MD"
    )
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", name.alias("f"))


@query(
    "slug_base",
    f"""SELECT p_partkey, p_size || '-' || {_SLUG} AS slug,
        CAST(regexp_extract(f, '^(\\d+)_', 1) AS INTEGER) AS article_order
    FROM (SELECT p_partkey, p_size, {_PART_FILE} AS f FROM part)""",
)
def slug_base(spark, sf_dir):
    return part_files(spark, sf_dir).select(
        "p_partkey",
        names.base_slug(F.col("f"), F.col("p_size")).alias("slug"),
        names.article_order(F.col("f")).alias("article_order"),
    )


@query(
    "folder_names",
    f"""SELECT doc_id, ({SOURCE_NUMBER}) AS category_id, 'topic-of-' || source AS category_slug
    FROM documents""",
)
def folder_names(spark, sf_dir):
    folder = say(F.format_string("%02d_", source_number()), "Topic_of_", F.col("source"))
    return documents(spark, sf_dir).select(
        "doc_id",
        names.category_id(folder).alias("category_id"),
        names.category_slug(folder).alias("category_slug"),
    )


@query(
    "slug_collisions",
    r"""WITH r AS (SELECT p_partkey, slug, nr, count(*) OVER (PARTITION BY slug) AS members,
            row_number() OVER (PARTITION BY slug, nr ORDER BY path) AS nth
        FROM (SELECT p_partkey, p_partkey % 7 AS nr, format('{:09d}', p_partkey) AS path,
            lower(replace(p_name, ' ', '-')) || '-' || lower(replace(p_brand, '#', '-')) AS slug FROM part))
    SELECT p_partkey, CASE WHEN members = 1 THEN slug ELSE slug || '-'
        || CASE WHEN nr > 0 THEN format('{:03d}', nr) ELSE 'duplicate' END
        || CASE WHEN nth > 1 THEN '-' || nth ELSE '' END END AS slug FROM r""",
)
def slug_collisions(spark, sf_dir):
    key = F.col("p_partkey")
    slugs = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.lower(
            say(F.translate("p_name", " ", "-"), "-", F.translate("p_brand", "#", "-"))
        ).alias("slug"),
        (key % 7).cast("int").alias("article_order"),
        F.format_string("%09d", key).alias("file_path"),
    )
    return collisions.resolve_slugs(slugs).select("p_partkey", "slug")


@query(
    "repeated_slugs",
    """SELECT lower(p_brand) AS slug, count(*) AS rows FROM part GROUP BY 1 HAVING count(*) > 1""",
)
def repeated_slugs(spark, sf_dir):
    return collisions.repeated_slugs(
        table(spark, sf_dir, "part").select(F.lower("p_brand").alias("slug"))
    )


# First sentence of a page, as a title with all kinds of signs.
_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"


def page_titles(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title")
    )


@query(
    "sanitize_filename",
    rf"""SELECT page_id, CASE WHEN s = '' THEN 'untitled' ELSE lower(s) END AS filename
    FROM (SELECT page_id, CASE WHEN length(k) > 80 THEN regexp_replace(left(k, 80), '_+$', '') ELSE k END AS s
        FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_TITLE},
            '[<>:"/\\|?*]', '', 'g'), '\s+', '_', 'g'), '[^\p{{L}}\p{{N}}_\-.]', '', 'g'),
            '^[_. ]+|[_. ]+$', '', 'g') AS k FROM pages))""",
)
def sanitize_filename(spark, sf_dir):
    return page_titles(spark, sf_dir).select(
        "page_id", names.safe_filename(F.col("title")).alias("filename")
    )


@query(
    "slugify",
    rf"""SELECT page_id, regexp_replace(left(regexp_replace(regexp_replace({sql_trim(f"lower({_TITLE})")},
        '[^\p{{L}}\p{{N}}_\s-]', '', 'g'), '[\s_]+', '_', 'g'), 80), '^_+|_+$', '', 'g') AS slug
    FROM pages""",
)
def slugify(spark, sf_dir):
    return page_titles(spark, sf_dir).select("page_id", names.slugify(F.col("title")).alias("slug"))


@query(
    "display_names",
    r"""SELECT p_partkey, array_to_string(list_transform(string_split(p_name || ' ' || lower(p_type), ' '),
        lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS shown FROM part""",
)
def display_names(spark, sf_dir):
    folder = say("07_", F.translate("p_name", " ", "_"), "_", F.lower("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", names.display_name(folder).alias("shown"))


_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1))"


@query(
    "external_hosts",
    f"""SELECT page_id, {_HOST} AS host, NOT (contains({_HOST}, 'example.com') OR contains({_HOST}, 'example.org'))
        AS external FROM pages""",
)
def external_hosts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        names.url_host(url).alias("host"),
        names.is_external(url, KNOWN_HOSTS).alias("external"),
    )


@query(
    "site_names",
    f"""SELECT page_id, CASE WHEN contains(url, 'blog.') THEN 'Blog'
        WHEN contains(url, 'spam-farm') THEN 'Spam Farm' WHEN contains(url, 'm.th') THEN 'Mobile'
        ELSE array_to_string(list_transform(string_split(l, '-'),
            lambda w: upper(left(w, 1)) || lower(substr(w, 2))), '-') END AS site
    FROM (SELECT page_id, url, string_split(replace({_HOST}, 'www.', ''), '.')[1] AS l FROM pages)""",
)
def site_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", names.site_name(F.col("url"), SITES).alias("site")
    )


@query(
    "resolved_urls",
    r"""SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/about/us.html?p=' || page_id AS rooted,
        regexp_extract(url, '^([a-z]+:)', 1) || '//other.example/x' AS same_scheme, url AS absolute
    FROM pages""",
)
def resolved_urls(spark, sf_dir):
    base, page = F.col("url"), F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        names.resolve_url(base, say("/about/./team/../us.html?p=", page)).alias("rooted"),
        names.resolve_url(base, F.lit("//other.example/x")).alias("same_scheme"),
        names.resolve_url(F.lit("https://index.example/a/b.html"), base).alias("absolute"),
    )
