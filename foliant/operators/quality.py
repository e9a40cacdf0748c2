"""Data-quality checks: measures of the stored tables and their verdicts.

Every table is scanned once; its measures are counted together, and the
verdicts are expressions over the one row of measures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import citations as cite
from ..functions import text as tx
from ..functions import vectors
from ..functions.patterns import WEB_SPACE
from .keyed import absent_rows, one_sided

# Accepted chunks per article, rows listed.
AVERAGE_CHUNKS = (2, 30)
LISTED_ARTICLES = 10
LISTED_SLUGS = 20


def _count(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def _empty(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def _check(
    check_id: str, status: Column, value: Column, expected: Column | None = None
) -> Column:
    wanted = F.lit(None) if expected is None else expected
    return F.struct(
        F.lit(check_id).alias("check_id"),
        status.alias("status"),
        value.cast("bigint").alias("value"),
        wanted.cast("bigint").alias("expected"),
    )


def _none(check_id: str, count: str, level: str) -> Column:
    """PASS when the count is zero, else the given level."""
    status = F.when(F.col(count) == 0, "PASS").otherwise(level)
    return _check(check_id, status, F.col(count), F.lit(0))


def _rows(measures: DataFrame, section: str, checks: Sequence[Column]) -> DataFrame:
    listed = measures.select(F.explode(F.array(*checks)).alias("c"))
    return listed.where(F.col("c.status").isNotNull()).select(
        F.lit(section).alias("section"),
        "c.*",
    )


def expectations(categories: DataFrame) -> DataFrame:
    """One row from the category table: how many articles and categories there should be."""
    return categories.agg(
        F.coalesce(F.sum("article_count"), F.lit(0)).cast("bigint").alias("expected_articles"), F.count("*").alias("expected_categories")
    )


def category_counts(articles: DataFrame, categories: DataFrame) -> DataFrame:
    """Every category with its expected and found articles and whether they agree; unknown ones expect none.

    Articles are counted before anything is joined.
    """
    found = articles.groupBy(F.col("category_id").alias("id")).agg(F.count("*").alias("found"))
    wanted = categories.select("id", F.col("article_count").cast("bigint").alias("expected"))
    both = found.select("id", "found", F.lit(None).cast("bigint").alias("expected")).unionByName(
        wanted.select("id", F.lit(None).cast("bigint").alias("found"), "expected")
    )
    rows = both.groupBy("id").agg(
        F.coalesce(F.max("expected"), F.lit(0)).alias("expected"), F.coalesce(F.max("found"), F.lit(0)).alias("found"),
        F.max(F.col("expected").isNotNull()).alias("known"),
    )
    short, more = F.col("found") < F.col("expected"), F.col("found") > F.col("expected")
    status = F.when(~F.col("known"), "FAIL").when(short, "FAIL").when(more, "WARN").otherwise("PASS")
    return rows.select("id", "expected", "found", status.alias("status"))


def check_articles(articles: DataFrame, expected: DataFrame) -> DataFrame:
    """Count, empty bodies, titles, slugs, categories and stubs, against a row of ``expectations``."""
    empty = _empty("content")
    measures = articles.agg(
        F.count("*").alias("total"),
        _count(~F.col("is_stub") & empty).alias("empty_full"),
        _count(F.col("is_stub") & empty).alias("empty_stub"),
        _count(_empty("title")).alias("untitled"),
        (F.count("slug") - F.count_distinct("slug")).alias("repeated_slugs"),
        F.count_distinct("category_id").alias("categories"),
        _count(F.col("is_stub")).alias("stubs"),
    )
    measures = _gather(measures, expected.select("expected_articles", "expected_categories"))
    total, wanted = F.col("total"), F.col("expected_articles")
    categories = F.col("categories")
    return _rows(
        measures,
        "articles",
        [
            _check(
                "article_count",
                F.when(total < wanted, "FAIL").when(total > wanted, "WARN").otherwise("PASS"),
                total,
                wanted,
            ),
            _none("empty_full_articles", "empty_full", "FAIL"),
            _check(
                "empty_stubs",
                F.when(F.col("empty_stub") > 0, "WARN"),
                F.col("empty_stub"),
                F.lit(0),
            ),
            _none("missing_titles", "untitled", "FAIL"),
            _none("repeated_slugs", "repeated_slugs", "FAIL"),
            _check(
                "category_count",
                F.when(categories == F.col("expected_categories"), "PASS").otherwise("FAIL"),
                categories,
                F.col("expected_categories"),
            ),
            _none("stubs", "stubs", "WARN"),
        ],
    )


def missing_chunks(articles: DataFrame, chunks: DataFrame) -> DataFrame:
    """Full articles without a chunk."""
    full = articles.where(~F.col("is_stub"))
    return absent_rows(full, chunks.select(F.col("article_id").alias("id")), ["id"])


def first_missing(missing: DataFrame, shown: int = LISTED_ARTICLES) -> DataFrame:
    """The first ids and, beside each, how many more there are than are shown."""
    total = missing.agg(F.greatest(F.count("*") - shown, F.lit(0)).alias("more"))
    return missing.select("id").orderBy("id").limit(shown).withColumn("more", total.scalar())


def _gather(*parts: DataFrame) -> DataFrame:
    """One row from several one-row tables with different columns."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def check_chunks(articles: DataFrame, chunks: DataFrame, dimensions: int = vectors.DIMENSIONS) -> DataFrame:
    """Chunks present, articles covered, vectors present and of the right length, average."""
    kind = chunks.schema["embedding"].dataType
    length = vectors.dimensions(F.col("embedding"), kind)
    some_vector = F.col("embedding").isNotNull()
    measures = _gather(
        chunks.agg(
            F.count("*").alias("chunks"),
            _count(~some_vector).alias("no_vector"),
            _count(some_vector & (length != dimensions)).alias("wrong_length"),
        ),
        articles.agg(_count(~F.col("is_stub")).alias("full")),
        missing_chunks(articles.select("id", "is_stub"), chunks).agg(
            F.count("*").alias("missing")
        ),
    )
    some = F.col("chunks") > 0
    average = F.round(F.try_divide("chunks", "full"), 1)
    low, high = AVERAGE_CHUNKS
    checks = [
        _none("articles_without_chunks", "missing", "FAIL"),
        _none("chunks_without_vector", "no_vector", "WARN"),
        _check(
            "vector_length",
            F.when(F.col("no_vector") == F.col("chunks"), "WARN")
            .when(F.col("wrong_length") == 0, "PASS")
            .otherwise("FAIL"),
            F.col("wrong_length"),
            F.lit(0),
        ),
        _check(
            "average_chunks",
            F.when(F.col("full") > 0, F.when(average.between(low, high), "PASS").otherwise("WARN")),
            F.round(average * 10),
        ),
    ]
    shown = [
        _check("chunks_present", F.when(some, "PASS").otherwise("WARN"), F.col("chunks")),
        *[c.withField("status", F.when(some, c["status"])) for c in checks],
    ]
    return _rows(measures, "chunks", shown)


def orphan_verses(verses: DataFrame, linked: DataFrame) -> DataFrame:
    """Verses no article refers to."""
    return absent_rows(verses, linked.select(F.col("verse_id").alias("id")), ["id"])


def check_verses(
    bible: DataFrame, quran: DataFrame, bible_links: DataFrame, quran_links: DataFrame
) -> DataFrame:
    """Orphans and number ranges; one warning when there are no verses at all."""
    measures = _gather(
        bible.agg(
            F.count("*").alias("bible"),
            _count(F.col("chapter") < 1).alias("bad_chapter"),
            _count(F.col("verse_start") < 1).alias("bad_verse"),
        ),
        quran.agg(
            F.count("*").alias("quran"),
            _count((F.col("surah") < 1) | (F.col("surah") > cite.SURAHS)).alias("bad_surah"),
            _count(F.col("ayah_start") < 1).alias("bad_ayah"),
        ),
        orphan_verses(bible, bible_links).agg(F.count("*").alias("bible_orphans")),
        orphan_verses(quran, quran_links).agg(F.count("*").alias("quran_orphans")),
    )
    some_bible, some_quran = F.col("bible") > 0, F.col("quran") > 0

    def only(condition: Column, check: Column) -> Column:
        return check.withField("status", F.when(condition, check["status"]))

    nothing = ~some_bible & ~some_quran
    return _rows(
        measures,
        "verses",
        [
            _check("verses_present", F.when(nothing, "WARN"), F.col("bible") + F.col("quran")),
            only(some_bible, _none("bible_orphans", "bible_orphans", "WARN")),
            only(some_quran, _none("quran_orphans", "quran_orphans", "WARN")),
            only(some_quran, _none("surah_range", "bad_surah", "FAIL")),
            only(some_quran, _none("ayah_start", "bad_ayah", "FAIL")),
            only(some_bible, _none("chapter", "bad_chapter", "FAIL")),
            only(some_bible, _none("verse_start", "bad_verse", "FAIL")),
        ],
    )


def tally(checks: DataFrame) -> DataFrame:
    """Checks per status."""
    return checks.groupBy("status").agg(F.count("*").alias("checks"))


def run_failed(checks: DataFrame) -> DataFrame:
    """One row: whether any check failed."""
    return checks.agg(F.coalesce(F.bool_or(F.col("status") == "FAIL"), F.lit(False)).alias("failed"))


def audit_contract(local: DataFrame, stored: DataFrame) -> DataFrame:
    """Slug differences and empty bodies between the files and the stored table."""
    sides = one_sided(local, stored, "slug").agg(
        _count(F.col("side") == "left").alias("only_local"),
        _count(F.col("side") == "right").alias("only_stored"),
    )
    blank = tx.is_blank(F.col("content"), WEB_SPACE)
    stub = F.coalesce(F.col("is_stub"), F.lit(False))
    table = stored.agg(
        F.count("*").alias("stored_rows"),
        F.count_distinct("category_id").alias("stored_categories"),
        _count(~stub & blank).alias("empty_full"),
        _count(stub & blank).alias("empty_stubs"),
    )
    measures = _gather(sides, table, local.agg(F.count("*").alias("local_rows")))
    info = F.lit("INFO")
    return _rows(
        measures,
        "audit",
        [
            _check("local_rows", info, F.col("local_rows")),
            _check("stored_rows", info, F.col("stored_rows")),
            _check("stored_categories", info, F.col("stored_categories")),
            _none("only_local", "only_local", "FAIL"),
            _none("only_stored", "only_stored", "FAIL"),
            _none("empty_full", "empty_full", "FAIL"),
            _check("empty_stubs", info, F.col("empty_stubs")),
        ],
    )


def first_slugs(df: DataFrame, slug: str = "slug", n: int = LISTED_SLUGS) -> DataFrame:
    """The first slugs in locale order."""
    return df.select(slug).orderBy(F.collate(F.col(slug), "UNICODE"), slug).limit(n)
