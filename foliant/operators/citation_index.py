"""Citation index: citations, counts per article, verse tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import citations as cite

VERSE = ["scheme", "book", "testament", "chapter", "verse_start", "verse_end"]


def extract_citations(articles: DataFrame, article_id: str = "id", text: str = "content") -> DataFrame:
    """One row per citation, both schemes in one pass over the texts.

    Texts without a number pair are dropped before the patterns run, and only
    the id and the matched words leave the scan.
    """
    matches = (
        articles.where(cite.has_numbers(F.col(text)))
        .select(F.col(article_id).alias("article_id"), F.explode(cite.cited(F.col(text))).alias("_m"))
    )
    chapter, start, end = cite.numbers_of(F.col("_m"))
    tokens = cite.token_table(articles.sparkSession)
    return (
        matches.select(
            "article_id",
            # Never NULL, which spares the join a test that would run the pattern again.
            F.coalesce(cite.token_of(F.col("_m")), F.lit("")).alias("token"),
            chapter.alias("chapter"),
            start.alias("verse_start"),
            end.alias("verse_end"),
        )
        .join(F.broadcast(tokens), "token")
        .where(
            (F.col("scheme") == "bible")
            | cite.quran_in_bounds(F.col("chapter"), F.col("verse_start"), F.col("verse_end"))
        )
        .select("article_id", *VERSE)
    )


def with_reference(df: DataFrame) -> DataFrame:
    """Add the reference text and the natural key."""
    parts = [F.col(c) for c in ("book", "chapter", "verse_start", "verse_end")]
    return df.withColumn("reference", cite.reference(*parts)).withColumn(
        "verse_key", cite.verse_key(*parts)
    )


def count_per_article(citations: DataFrame) -> DataFrame:
    """Occurrences of every verse in every article."""
    counted = citations.groupBy("article_id", *VERSE).agg(
        F.count("*").cast("int").alias("occurrence_count")
    )
    return with_reference(counted)


def verse_table(junction: DataFrame) -> DataFrame:
    """Distinct verses with a stable id."""
    distinct = with_reference(junction.select(*VERSE).distinct())
    return distinct.select(
        cite.verse_id(F.col("scheme"), F.col("verse_key")).alias("id"),
        *VERSE,
        "reference",
        "verse_key",
    )


def bible_verses(verses: DataFrame) -> DataFrame:
    return verses.where(F.col("scheme") == "bible").select(
        "id", "book", "chapter", "verse_start", "verse_end", "reference", "testament"
    )


def quran_verses(verses: DataFrame) -> DataFrame:
    return verses.where(F.col("scheme") == "quran").select(
        "id",
        F.col("chapter").alias("surah"),
        F.col("verse_start").alias("ayah_start"),
        F.col("verse_end").alias("ayah_end"),
        "reference",
        F.lit(None).cast("string").alias("surah_name"),
    )


def link_verses(junction: DataFrame, verses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Junction rows with the id of their verse, and the rows without a known verse."""
    known = verses.select("scheme", "verse_key", F.col("id").alias("verse_id"))
    linked = junction.join(known, ["scheme", "verse_key"]).select(
        "article_id", "verse_id", "occurrence_count"
    )
    unknown = junction.join(known, ["scheme", "verse_key"], "left_anti").select(
        "article_id", "scheme", "verse_key"
    )
    return linked, unknown


def totals_per_verse(junction: DataFrame) -> DataFrame:
    return with_reference(
        junction.groupBy(*VERSE).agg(
            F.sum("occurrence_count").alias("total_occurrences"),
            F.count("*").alias("article_count"),
        )
    )


def top_verses(junction: DataFrame, n: int = 10) -> DataFrame:
    """Most cited verses; equal totals in key order."""
    return (
        totals_per_verse(junction)
        .orderBy(F.desc("total_occurrences"), "verse_key")
        .limit(n)
        .select("reference", "total_occurrences", "article_count")
    )


def top_linked(linked: DataFrame, verses: DataFrame, n: int = 10) -> DataFrame:
    """Most cited verse ids with their label, the id where the verse is unknown.

    A missing count is one.  The totals are cut to ``n`` rows before the join.
    """
    totals = (
        linked.groupBy("verse_id")
        .agg(F.sum(F.coalesce("occurrence_count", F.lit(1))).alias("citations"))
        .orderBy(F.desc("citations"), "verse_id")
        .limit(n)
    )
    name = F.col("surah_name") if "surah_name" in verses.columns else F.lit(None).cast("string")
    label = F.when(
        F.coalesce(name, F.lit("")) != "", F.concat("reference", F.lit(" ("), name, F.lit(")"))
    ).otherwise(F.col("reference"))
    named = verses.select(F.col("id").alias("verse_id"), label.alias("label"))
    return totals.join(named, "verse_id", "left").select(
        F.coalesce("label", "verse_id").alias("label"), "citations"
    )


def index_summary(junction: DataFrame) -> DataFrame:
    """Totals of one run by scheme: references, distinct verses and junction rows."""
    per_verse = junction.groupBy("scheme", "book", "chapter", "verse_start", "verse_end").agg(
        F.sum("occurrence_count").alias("refs"), F.count("*").alias("rows")
    )
    return per_verse.groupBy("scheme").agg(
        F.sum("refs").alias("refs_found"),
        F.count("*").alias("unique_verses"),
        F.sum("rows").alias("junction_rows"),
    )


def run_report(articles: DataFrame, junction: DataFrame, unknown: DataFrame) -> DataFrame:
    """One row on a run: articles seen, articles with citations, and rejects.

    ``unknown`` are the junction rows without a known verse, of `link_verses`;
    an article failed when any of its rows was rejected.
    """
    counted = (
        articles.select(F.lit(1).alias("a"), F.lit(0).alias("c"), F.lit(0).alias("f"), F.lit(0).alias("r"))
        .unionAll(junction.select("article_id").distinct().select(F.lit(0), F.lit(1), F.lit(0), F.lit(0)))
        .unionAll(unknown.select("article_id").distinct().select(F.lit(0), F.lit(0), F.lit(1), F.lit(0)))
        .unionAll(unknown.select(F.lit(0), F.lit(0), F.lit(0), F.lit(1)))
    )
    names = {"a": "articles_processed", "c": "articles_with_citations", "f": "articles_failed", "r": "rows_rejected"}
    return counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in names.items()])


def warnings(unknown: DataFrame, shown: int = 20) -> DataFrame:
    """The first rejects as messages; the last row says how many more there are.

    Only as many rows as are shown come together in one task.
    """
    listed = unknown.orderBy("article_id", "scheme", "verse_key").limit(shown).select(
        F.lit(0).alias("place"),
        F.concat(F.lit("article "), "article_id", F.lit(": no "), "scheme", F.lit(" verse "), "verse_key").alias("warning"),
    )
    more = unknown.agg((F.count("*") - shown).alias("more")).where("more > 0").select(
        F.lit(1).alias("place"), F.concat(F.lit("and "), F.col("more").cast("string"), F.lit(" more")).alias("warning")
    )
    return listed.unionAll(more)
