"""Unique slugs for articles whose base slug is shared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import staged
from .ranking import numbered


def shared_slugs(
    df: DataFrame, slug: str = "slug", order: str = "article_order", path: str = "file_path"
) -> DataFrame:
    """Path and unique slug of every article whose slug is shared.

    Every member gets its order number as suffix, `duplicate` without one; the
    second and later members of the same suffix get a running number as well,
    in path order.  Numbers whose slug is natural elsewhere, or is the first slug of
    another suffix, are left out.

    The free numbers are counted and not tried: with j - 1 taken numbers below it, the
    taken number n stands behind n - j free ones, so a member's number is its place among
    members and taken numbers put in that order.  The number of jobs does not
    depend on how many slugs conflict.
    """
    narrow = staged(df.select(slug, order, path), "slugs")
    counted = narrow.groupBy(slug).agg(F.count("*").alias("_members"))
    members = narrow.join(counted.where("_members > 1").select(slug), slug, "left_semi")
    suffix = F.when(F.col(order) > 0, F.format_string("%03d", F.col(order))).otherwise("duplicate")
    based = members.select(path, F.concat(F.col(slug), F.lit("-"), suffix).alias("_base"))
    placed = numbered(based, ["_base"], [path], "_nth")
    taken = _taken(counted.where("_members = 1").select(slug), placed.select("_base").distinct())
    if not taken.isEmpty():
        ranked = numbered(taken, ["_base"], ["_n"], "_j")
        ahead = ranked.select("_base", F.lit(None).cast("string").alias(path), (F.col("_n") - F.col("_j")).alias("_key"), F.lit(1).alias("_kind"))
        both = placed.select("_base", path, F.col("_nth").alias("_key"), F.lit(0).alias("_kind")).unionByName(ahead)
        placed = numbered(both, ["_base"], ["_key", "_kind"], "_nth").where("_kind = 0")
    return placed.select(path, _running(F.col("_base"), F.col("_nth")).alias("unique_slug"))


def _taken(natural: DataFrame, bases: DataFrame) -> DataFrame:
    """Numbers that are not free: ``_base`` and ``_n``, which is 1 for the base itself."""
    slugs = natural.toDF("_slug")
    whole = slugs.select(F.col("_slug").alias("_base"), F.lit(1).cast("bigint").alias("_n"))
    every = slugs.unionAll(bases.toDF("_slug"))
    parts = r"^(.*)-([1-9][0-9]{0,17})$"
    numbers = every.select(
        F.regexp_extract("_slug", parts, 1).alias("_base"), F.expr(f"try_cast(regexp_extract(_slug, r'{parts}', 2) AS bigint)").alias("_n")
    )
    return whole.unionAll(numbers.where("_n > 1")).join(bases, "_base", "left_semi").distinct()


def _running(base, nth):
    return F.when(nth > 1, F.concat(base, F.lit("-"), nth.cast("string"))).otherwise(base)


def resolve_slugs(
    df: DataFrame,
    slug: str = "slug",
    order: str = "article_order",
    path: str = "file_path",
    keys: DataFrame | None = None,
) -> DataFrame:
    """The table with unique slugs; the path identifies a row.

    Slugs are resolved on ``keys``, the columns slug, order and path of the same
    rows, and joined back by path.  A caller that can derive these without the
    wide columns passes them, so that wide rows are computed once.
    """
    narrow = df.select(slug, order, path) if keys is None else keys
    renamed = shared_slugs(narrow, slug, order, path)
    return (
        df.join(renamed, path, "left")
        .withColumn(slug, F.coalesce("unique_slug", slug))
        .select(*df.columns)
    )


def repeated_slugs(df: DataFrame, slug: str = "slug") -> DataFrame:
    """Slugs that still occur more than once, with their count."""
    return df.groupBy(slug).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
