"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
all), BENCH_RUNS (timed runs after one warm-up, default 3), BENCH_QUERIES
(comma-separated names, `all` for every query).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from foliant.plans.catalog import QUERIES
from foliant.session import build_session

HEADLINE = [
    "citation_top10",
    "citation_bible_index",
    "verse_dim_distinct",
    "verse_junction_rejects",
    "articles_table",
    "header_parse",
    "article_summaries",
    "word_count_stub",
    "strip_markdown",
    "keyword_tags",
    "vtt_clean",
    "chunks_greedy",
    "hash_embed",
    "boilerplate_clean",
    "format_articles",
    "format_report",
    "html_text",
    "section_links",
    "slug_collisions",
    "url_first_dedup",
    "set_diff_audit",
    "keyed_merge_latest",
    "insert_ignore_merge",
    "batch_numbering",
    "index_markdown",
    "quality_articles",
    "quality_verses",
    "audit_contract",
]


def run(df) -> None:
    """Compute every column of every row without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = build_session(
        "foliant-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for attempt in range(runs + 1):
            start = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            if attempt or runs == 0:
                taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
        print(name, times[name], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
