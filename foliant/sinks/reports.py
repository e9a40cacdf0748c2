"""Index documents, run records and failure logs.

An index may be as large as its category, so it is a table of lines
(``folder``, ``line_no``, ``line``), written as text in line order, and is never
gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..operators.ranking import numbered


def _heads(per_folder: DataFrame, lines: list[Column]) -> DataFrame:
    """Fixed opening lines of every folder, numbered up to zero."""
    listed = F.array(*[line.cast("string") for line in lines])
    return per_folder.select("folder", F.posexplode(listed).alias("at", "line")).select(
        "folder", (F.col("at") - len(lines) + 1).cast("bigint").alias("line_no"), "line"
    )


def category_index(links: DataFrame) -> DataFrame:
    """Index lines of every folder: heading, total, then one numbered line per link.

    Needs ``folder``, ``position``, ``title``, ``url``, ``filename`` and ``failed``.
    """
    placed = numbered(links, ["folder"], ["position"], "line_no")
    shown = F.when(
        F.col("failed"), F.concat(F.lit("[FAILED] "), "title", F.lit(" - "), "url")
    ).otherwise(F.concat(F.lit("["), "title", F.lit("]("), "filename", F.lit(")")))
    lines = placed.select(
        "folder", "line_no", F.concat(F.col("line_no").cast("string"), F.lit(". "), shown).alias("line")
    )
    counts = links.groupBy("folder").agg(F.count("*").alias("n"))
    heads = _heads(
        counts,
        [
            F.concat(F.lit("# "), names.display_name(F.col("folder"))),
            F.lit(""),
            F.concat(F.lit("Total articles: "), F.col("n").cast("string")),
            F.lit(""),
        ],
    )
    return heads.unionByName(lines)


def master_index(
    links: DataFrame, heading: str, source: str
) -> DataFrame:
    """Lines of the index over all folders; the part before the first has folder ''.

    Order by (``folder``, ``line_no``).
    """
    placed = numbered(links, ["folder"], ["position"], "line_no")
    number = F.col("line_no").cast("string")
    filename = names.numbered_filename(F.col("line_no"), names.safe_filename(F.col("title")))
    lines = placed.select(
        "folder",
        "line_no",
        F.concat(
            F.lit("  "), number, F.lit(". ["), "title", F.lit("]("), "folder", F.lit("/"),
            filename, F.lit(")"),
        ).alias("line"),
    )
    counts = links.groupBy("folder").agg(F.count("*").alias("n"))
    heads = _heads(
        counts,
        [
            F.concat(
                F.lit("### ["), names.display_name(F.col("folder")), F.lit("]("),
                F.col("folder"), F.lit("/00_INDEX.md)"),
            ),
            F.concat(F.lit("*"), F.col("n").cast("string"), F.lit(" articles*")),
            F.lit(""),
        ],
    )
    tails = counts.select("folder", (F.col("n") + 1).alias("line_no"), F.lit("").alias("line"))
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("folders"))
    front = _heads(
        totals.withColumn("folder", F.lit("")),
        [
            F.lit(f"# {heading}"),
            F.lit(""),
            F.lit(f"Source: {source}"),
            F.lit(""),
            F.lit("---"),
            F.lit(""),
            F.lit("## Table of Contents"),
            F.lit(""),
            F.concat(
                F.lit("**Total: "), F.coalesce("n", F.lit(0)).cast("string"), F.lit(" articles across "),
                F.col("folders").cast("string"), F.lit(" categories**"),
            ),
            F.lit(""),
        ],
    )
    return front.unionByName(heads).unionByName(lines).unionByName(tails)


def write_lines(lines: DataFrame, path: str) -> None:
    """One folder of text parts per index folder; part names follow the line order."""
    (
        lines.repartitionByRange("folder", "line_no")
        .sortWithinPartitions("folder", "line_no")
        .select("folder", F.col("line").alias("value"))
        .write.mode("overwrite")
        .partitionBy("folder")
        .text(path)
    )


def counts_per_category(links: DataFrame, categories: DataFrame) -> DataFrame:
    """Links per category folder, over the fixed list of categories, and their total in every row."""
    counts = links.groupBy("folder").agg(F.count("*").alias("n"))
    listed = categories.join(counts, "folder", "left").select(
        "folder", F.coalesce("n", F.lit(0)).alias("n")
    )
    return listed.withColumn("total", listed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).scalar())


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_failures(failed: DataFrame, path: str) -> None:
    """Tab-separated log of folder, title and URL."""
    failed.select("folder", "title", "url").write.mode("overwrite").option("sep", "\t").csv(path)


def utc_stamp(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def local_stamp(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
