"""Standard articles from markdown or HTML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html, markup
from ..functions.once import of_name


def format_markdown(
    df: DataFrame,
    owners: Sequence[str] = (),
    sites: Mapping[str, str] | None = None,
    name: str = "formatted",
) -> DataFrame:
    """Add the formatted article.

    Needs ``title``, ``markdown``, ``source_url``, ``category_id`` and
    ``category_name``; ``source_name`` is used when present.  Text that is
    already formatted stays as it is.
    """
    text = F.col("markdown")
    halved = df.withColumn(
        "_single", F.when(markup.halves_alike(text), markup.first_half(text)).otherwise(text)
    )
    single = F.col("_single")
    fields = {f: markup.metadata_field(single, f) for f in markup.METADATA_FIELDS}
    header = markup.build_header(
        F.col("title"),
        F.col("source_url"),
        F.col("category_id"),
        F.col("category_name"),
        fields["Author"],
        F.coalesce(fields["Date"], fields["Published"]),
        sites or {},
        F.col("source_name") if "source_name" in df.columns else None,
    )
    body = markup.strip_space(
        markup.clean_markdown(markup.without_metadata(single), F.col("title"), owners)
    )
    formatted = F.when(markup.is_formatted(text), text).otherwise(
        F.concat(header, body, F.lit("\n"))
    )
    return halved.withColumn(name, formatted).drop("_single")


def format_html(df: DataFrame, **options) -> DataFrame:
    """As `format_markdown`, from a ``html`` column."""
    return format_markdown(df.withColumn("markdown", of_name(html.to_markdown, "html")), **options)
