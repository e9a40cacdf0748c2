"""Pages from the web, through a fetch function given by the caller.

Fetching runs inside tasks, so a list of URLs is spread over the cluster; the
library itself opens no connection.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html
from ..functions.once import of_name
from ..functions.text import count_words, is_stub, strip_space
from .encodings import decode

# Tries, waits per attempt in seconds, list pages followed, pauses
# in seconds between pages and between posts.
TRIES = 3
STATUS_WAIT = 3
CONNECTION_WAIT = 5
PAGE_PAUSE = 1.5
POST_PAUSE = 2.0


@dataclass
class Page:
    status: int
    body: bytes
    encoding: str | None = None


Fetch = Callable[[str], Page]


def fetch_with_retries(fetch: Fetch, url: str, sleep=time.sleep) -> Page | None:
    """A page, or None when it is missing or every try failed.

    A missing page and an unknown error end at once; other answers and time-outs
    wait three seconds more per try, lost connections five.
    """
    for attempt in range(1, TRIES + 1):
        try:
            page = fetch(url)
            if page.status < 400:
                return page
            if page.status == 404:
                return None
            wait = STATUS_WAIT
        except TimeoutError:
            wait = STATUS_WAIT
        except ConnectionError:
            wait = CONNECTION_WAIT
        except Exception:
            return None
        if attempt < TRIES:
            sleep(wait * attempt)
    return None


def decode_page(page: Page) -> str:
    """Text of a page by its byte order mark, the given or its own encoding, else by its bytes."""
    return decode(page.body, page.encoding)


def fetch_pages(
    urls: DataFrame, fetch: Fetch, pause: float = PAGE_PAUSE, sleep=time.sleep
) -> DataFrame:
    """Add ``html`` to rows with a ``url``; NULL where the page could not be had.

    Every task pauses between its pages, so the number of partitions sets the
    total rate; partition by host to bound the rate per host.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for url in batch["url"]:
                page = fetch_with_retries(fetch, url, sleep)
                texts.append(None if page is None else decode_page(page))
                sleep(pause)
            yield batch.assign(html=texts)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in urls.schema.fields)
    return urls.mapInPandas(run, f"{fields}, html string")


def post_links(pages: DataFrame) -> DataFrame:
    """Links inside post titles of list pages, with their text."""
    mark = rf"""class\s*=\s*["'](?:[^"']*\s)?{html.POST_LINK_CLASS}(?:\s[^"']*)?["']"""
    block = rf"(?is)<([a-z][a-z0-9]*)\b[^>]*?\b{mark}[^>]*>.*?</\1\s*>"
    anchors = F.flatten(
        F.transform(F.regexp_extract_all(html.visible(F.col("html")), F.lit(block), F.lit(0)), _anchors)
    )
    return (
        pages.select(F.explode(anchors).alias("link"))
        .select(
            html.unescape(F.col("link.href")).alias("url"),
            html.unescape(F.col("link.title")).alias("title"),
        )
        .where((F.col("url") != "") & (F.col("title") != ""))
    )


def _anchors(block: Column) -> Column:
    pattern = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a\s*>"""
    return F.transform(
        F.regexp_extract_all(block, F.lit(pattern), F.lit(0)),
        lambda a: F.struct(
            F.regexp_extract(a, pattern, 1).alias("href"),
            strip_space(F.regexp_replace(F.regexp_extract(a, pattern, 2), r"\s*<[^>]*>\s*", "")).alias(
                "title"
            ),
        ),
    )


def follow_list(start: str, fetch: Fetch, pages: int | None = None, sleep=time.sleep) -> list[str]:
    """URLs of the list pages: the start page and its chain of older pages.

    Each page names the next one, so this is a walk.  It ends at the last page, at
    a page seen before, or after ``pages`` steps where the caller asks for so many.
    """
    link = re.compile(
        r"""<a\b(?=[^>]*\bblog-pager-older-link\b)[^>]*\bhref\s*=\s*["']([^"']+)["']"""
        r"""|\bid\s*=\s*["']blog-pager-older-link["'][^>]*>.*?<a\b[^>]*\bhref\s*=\s*["']([^"']+)["']""",
        re.IGNORECASE | re.DOTALL,
    )
    seen: list[str] = []
    url: str | None = start
    while url and url not in seen and (pages is None or len(seen) < pages):
        page = fetch_with_retries(fetch, url, sleep)
        if page is None:
            break
        seen.append(url)
        older = link.search(decode_page(page))
        url = (older[1] or older[2]) if older else None
    return seen


def extract_posts(pages: DataFrame) -> DataFrame:
    """Post rows of fetched pages; pages without a body or with few words are dropped."""
    page = html.visible(F.col("html"))

    def area(*selectors: str) -> Column:
        return html.area_udf(selectors, by_priority=False, fallback=False)(page)

    found = pages.select(
        "url",
        area(*html.POST_TITLE_SELECTORS).alias("title_html"),
        area(*html.POST_BODY_SELECTORS).alias("body_html"),
        area(*html.POST_DATE_SELECTORS).alias("date_html"),
    )
    posts = found.select(
        F.coalesce(html.inner_text(F.col("title_html")), F.lit("Untitled")).alias("title"),
        "url",
        F.col("body_html").alias("html"),
        # A filter on what a generator gives stays above it.  Pushed down to the pages it would
        # convert every page a second time; a page without a body has no words either.
        F.explode(F.array(strip_space(of_name(html.to_markdown, "body_html")))).alias("content"),
        html.inner_text(F.col("date_html")).alias("publish_date"),
    )
    return posts.withColumn("word_count", count_words(F.col("content"))).where(
        ~is_stub(F.col("word_count"))
    )


def extract_articles(pages: DataFrame) -> DataFrame:
    """Title and markdown of fetched article pages."""
    return pages.select(
        "*",
        html.page_title(F.col("html")).alias("page_title"),
        html.to_markdown(html.content_area(F.col("html"))).alias("markdown"),
    )
