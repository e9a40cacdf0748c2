"""Registry of queries and readers of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, when SQL can express it, the SQL that checks it."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the schema is stated, so no file is opened to infer it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, for costly work on their texts."""
    return spread(documents(spark, sf_dir), "doc_id")


def say(*parts: Column | str) -> Column:
    """Concatenate columns and literal text."""
    return F.concat(
        *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    )


def source_number() -> Column:
    """Category number of a document: its source's number plus one."""
    return F.regexp_extract("source", r"(\d+)$", 1).cast("int") + 1


# The same derivations in SQL.
SOURCE_NUMBER = r"CAST(regexp_extract(source, '(\d+)$', 1) AS INTEGER) + 1"


def sql_text(text: str) -> str:
    """The text as an SQL literal."""
    return "E'" + text.replace("'", "''").replace("\n", "\\n") + "'"


def sql_trim(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def sql_words(text: str, pattern: str = r"\S+") -> str:
    return rf"CAST(len(regexp_extract_all({text}, '{pattern}')) AS INTEGER)"


def sql_tokens(words: str) -> str:
    return f"CAST(ceil({words} * CAST(1.3 AS DOUBLE)) AS INTEGER)"


def sql_rewrite(text: str, rules: list[tuple[str, str]]) -> str:
    """Nested replacements; a replacement is given as an SQL expression."""
    for pattern, replacement in rules:
        quoted = pattern.replace("'", "''")
        text = f"regexp_replace({text}, '{quoted}', {replacement}, 'g')"
    return text
