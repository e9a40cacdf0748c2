"""Slugs, file names, display names and URLs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .patterns import TEXT_SPACE, WORD
from .text import let, rewrite, strip_space, title_case

NAME_CHARS = 80


def _number_prefix(name: Column) -> Column:
    digits = F.nullif(F.regexp_extract(name, r"^(\d+)_", 1), F.lit(""))
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def category_id(folder: Column) -> Column:
    """Leading number of a folder name, 0 when there is none."""
    return _number_prefix(folder)


def article_order(filename: Column) -> Column:
    """Leading number of a file name, 0 when there is none."""
    return _number_prefix(filename)


def base_slug(filename: Column, category: Column, any_case_suffix: bool = True) -> Column:
    suffix = r"(?i)\.md\z" if any_case_suffix else r"\.md\z"
    stem = rewrite(filename, [(r"^\d+_", ""), (suffix, ""), (r"[^\w-]", "-"), (r"-{2,}", "-")])
    return F.concat(category.cast("string"), F.lit("-"), F.lower(stem))


def category_slug(folder: Column) -> Column:
    return F.lower(F.translate(F.regexp_replace(folder, r"^\d+_", ""), "_", "-"))


def safe_filename(title: Column, chars: int = NAME_CHARS) -> Column:
    kept = rewrite(
        title,
        [
            (r'[<>:"/\\|?*]', ""),
            (rf"[{TEXT_SPACE}]+", "_"),
            (rf"[^{WORD}\-.]", ""),
            (r"^[_. ]+|[_. ]+\z", ""),
        ],
    )

    def shortened(name: Column) -> Column:
        cut = F.regexp_replace(F.substring(name, 1, chars), r"_+\z", "")
        return F.when(F.length(name) > chars, cut).otherwise(name)

    named = F.nullif(let(kept, shortened), F.lit(""))
    return F.coalesce(F.lower(named), F.lit("untitled"))


def slugify(title: Column, chars: int = NAME_CHARS) -> Column:
    slug = rewrite(
        strip_space(F.lower(title)),
        [(rf"[^{WORD}{TEXT_SPACE}-]", ""), (rf"[{TEXT_SPACE}_]+", "_")],
    )
    return F.regexp_replace(F.substring(slug, 1, chars), r"^_+|_+\z", "")


def numbered_filename(position: Column, name: Column) -> Column:
    return F.concat(F.format_string("%03d_", position), name, F.lit(".md"))


def display_name(folder: Column) -> Column:
    """`07_some_topic` becomes `Some Topic`."""
    return title_case(F.translate(F.regexp_replace(folder, r"^[^_]*_", ""), "_", " "))


def url_key(url: Column) -> Column:
    """Two URLs with the same key are the same page."""
    return F.lower(F.regexp_replace(url, r"/+\z", ""))


def url_host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def is_external(url: Column, known_hosts: Sequence[str]) -> Column:
    """True when the URL has a host and it contains none of the known names."""
    host = url_host(url)
    known = F.lit(False)
    for name in known_hosts:
        known = known | F.contains(host, F.lit(name))
    return F.coalesce(~known, F.lit(False))


def site_name(url: Column, sites: Mapping[str, str]) -> Column:
    """Display name by substring rules, else the first label of the domain."""
    domain = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    label = F.substring_index(F.replace(domain, F.lit("www."), F.lit("")), ".", 1)
    name = title_case(label)
    for part, shown in reversed(list(sites.items())):
        name = F.when(F.contains(url, F.lit(part)), F.lit(shown)).otherwise(name)
    return name


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve a link against its page; relative paths need the standard rules."""

    @F.pandas_udf(T.StringType())
    def joined(bases: pd.Series, hrefs: pd.Series) -> pd.Series:
        from urllib.parse import urljoin

        return pd.Series(
            [None if b is None or h is None else urljoin(b, h) for b, h in zip(bases, hrefs)],
            dtype="object",
        )

    return joined(base, href)
