"""Chunks, vectors and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors
from ..operators import chunking, quality
from .base import SOURCE_NUMBER, documents, query, say, source_number, table, texts

# Vectors of the embeddings table.
TABLE_DIMENSIONS = 64


def articles_of(spark, sf_dir):
    """Documents as articles, every line a paragraph of its own."""
    doc = F.col("doc_id")
    return texts(spark, sf_dir).select(
        doc.cast("string").alias("id"),
        say("doc-", F.format_string("%09d", doc)).alias("slug"),
        say("Document ", doc).alias("title"),
        F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("content"),
        (F.col("n_chars") < 300).alias("is_stub"),
        source_number().alias("category_id"),
    )


def _pieces(words: str, budget: str) -> str:
    """Pieces of a word list by the budget, as SQL."""
    size = f"CAST(floor({budget} / CAST(1.3 AS DOUBLE)) AS BIGINT)"
    return f"""list_transform(generate_series(0, (len({words}) - 1) // {size}),
        lambda i: array_to_string({words}[(i * {size} + 1):(i * {size} + {size})], ' '))"""


_TOKENS = "CAST(ceil(len(regexp_extract_all({}, '\\S+')) * CAST(1.3 AS DOUBLE)) AS INTEGER)"
_CHUNKS = rf"""
    a AS (SELECT doc_id, 'Document ' || doc_id AS title, replace(text, chr(10), chr(10) || chr(10)) AS content,
            CASE WHEN len(regexp_extract_all(text, '\S+')) BETWEEN 200 AND 1999 THEN 600 ELSE 700 END AS budget
        FROM documents WHERE n_chars >= 300),
    p AS (SELECT *, list_filter(list_transform(regexp_split_to_array(content, '\n\n+'),
            lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ps FROM a),
    s AS (SELECT *, flatten(list_transform(ps, lambda x: CASE WHEN {_TOKENS.format("x")} > budget
            THEN list_transform({_pieces(r"regexp_extract_all(x, '\S+')", "budget")},
                lambda y: {{'done': CAST([] AS VARCHAR[]), 'open': y, 'tokens': 0, 'whole': false}})
            ELSE [{{'done': CAST([] AS VARCHAR[]), 'open': x, 'tokens': {_TOKENS.format("x")}, 'whole': true}}] END)) AS xs
        FROM p),
    m AS (SELECT *, list_reduce(xs, lambda acc, x: CASE
            WHEN NOT x.whole THEN {{'done': CASE WHEN acc.open IS NULL THEN acc.done ELSE list_append(acc.done, acc.open) END || [x.open],
                'open': NULL, 'tokens': 0, 'whole': true}}
            WHEN acc.open IS NOT NULL AND acc.tokens + x.tokens <= budget THEN {{'done': acc.done,
                'open': acc.open || chr(10) || chr(10) || x.open, 'tokens': acc.tokens + x.tokens, 'whole': true}}
            ELSE {{'done': CASE WHEN acc.open IS NULL THEN acc.done ELSE list_append(acc.done, acc.open) END,
                'open': x.open, 'tokens': x.tokens, 'whole': true}} END,
            {{'done': CAST([] AS VARCHAR[]), 'open': CAST(NULL AS VARCHAR), 'tokens': 0, 'whole': true}}) AS r FROM s),
    raw AS (SELECT doc_id, title, CASE WHEN len(xs) = 0 THEN [regexp_replace(content, '^\s+|\s+$', '', 'g')]
            WHEN r.open IS NULL THEN r.done ELSE list_append(r.done, r.open) END AS cs FROM m),
    bounded AS (SELECT doc_id, title, flatten(list_transform(cs, lambda c:
            CASE WHEN {_TOKENS.format("'[' || title || '] - ' || c")} > 700
            THEN {_pieces(r"regexp_extract_all(c, '\S+')", "700")} ELSE [c] END)) AS cs FROM raw),
    chunks AS (SELECT CAST(doc_id AS VARCHAR) AS article_id, CAST(i - 1 AS INTEGER) AS chunk_index,
            '[' || title || '] - ' || cs[i] AS content
        FROM (SELECT *, unnest(generate_series(1, len(cs))) AS i FROM bounded))
"""


def chunks_of(spark, sf_dir):
    return chunking.chunk_articles(articles_of(spark, sf_dir).where(~F.col("is_stub")))


@query(
    "chunks_greedy",
    f"WITH {_CHUNKS} SELECT *, {_TOKENS.format('content')} AS token_count FROM chunks",
)
def chunks_greedy(spark, sf_dir):
    return chunks_of(spark, sf_dir)


@query(
    "chunk_stats",
    f"""WITH {_CHUNKS} SELECT chunks, articles, round(chunks / articles, 1) AS average
    FROM (SELECT (SELECT count(*) FROM chunks) AS chunks,
        (SELECT count(*) FROM documents WHERE n_chars >= 300) AS articles)""",
)
def chunk_stats(spark, sf_dir):
    return chunking.chunk_averages(chunks_of(spark, sf_dir), articles_of(spark, sf_dir))


_DIGEST = "array_to_string([sha256(k || ':' || content) FOR k IN [0, 1]], '')"
_VECTOR = f"""[CAST(CAST('0x' || substr({_DIGEST}, 4 * i + 1, 4) AS INTEGER) AS DOUBLE) / 32768 - 1
    FOR i IN generate_series(0, 31)]"""


@query(
    "hash_embed",
    f"""WITH {_CHUNKS}, made AS (SELECT article_id, chunk_index, {_TOKENS.format('content')} AS token_count,
            {_VECTOR} AS v FROM chunks)
    SELECT article_id, chunk_index, token_count, CAST(len(v) AS INTEGER) AS dims, v[1] AS first_value,
        v[20] AS twentieth_value, list_sum(v) AS total FROM made""",
)
def hash_embed(spark, sf_dir):
    """The stand-in model's numbers are multiples of a power of two, so their sums are exact."""
    embedded = chunking.embed(
        chunks_of(spark, sf_dir), chunking.digest_embedder(32), pause=0, dimensions=32
    )
    value = F.transform("embedding", lambda x: x.cast("double"))
    return embedded.select(
        "article_id", "chunk_index", "token_count", F.size("embedding").alias("dims"),
        F.get(value, F.lit(0)).alias("first_value"), F.get(value, F.lit(19)).alias("twentieth_value"),
        F.aggregate(value, F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


@query(
    "pending_articles",
    """SELECT CAST(doc_id AS VARCHAR) AS id FROM documents ANTI JOIN labels USING (doc_id)
    WHERE n_chars >= 300""",
)
def pending_articles(spark, sf_dir):
    stored = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("article_id"))
    return chunking.pending(articles_of(spark, sf_dir).select("id", "is_stub"), stored).select("id")


@query(
    "embedding_dims",
    f"""SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims, len(embedding) = {TABLE_DIMENSIONS} AS fits,
        CAST(len(embedding) AS INTEGER) AS dims_of_text FROM embeddings""",
)
def embedding_dims(spark, sf_dir):
    stored = table(spark, sf_dir, "embeddings")
    as_text = stored.withColumn("as_text", F.col("embedding").cast("string"))
    kinds = as_text.schema
    dims = vectors.dimensions(F.col("embedding"), kinds["embedding"].dataType)
    return as_text.select(
        "vec_id",
        dims.alias("dims"),
        (dims == TABLE_DIMENSIONS).alias("fits"),
        vectors.dimensions(F.col("as_text"), kinds["as_text"].dataType).alias("dims_of_text"),
    )




def _checks_sql(section: str, rows: list[tuple[str, str, str, str]], source: str) -> str:
    """Union of check rows over one row of measures."""
    parts = [
        f"SELECT '{section}' AS section, '{i}' AS check_id, {status} AS status, "
        f"CAST({value} AS BIGINT) AS value, CAST({wanted} AS BIGINT) AS expected FROM m"
        for i, status, value, wanted in rows
    ]
    union = " UNION ALL ".join(parts)
    return f"WITH m AS ({source}) SELECT * FROM ({union}) WHERE status IS NOT NULL"


# The category table: the documents of every source, one more or less here and there.
CATEGORIES_SQL = f"""(SELECT id, n + id % 3 - 1 AS article_count
    FROM (SELECT {SOURCE_NUMBER} AS id, count(*) AS n FROM documents GROUP BY ALL))"""


def categories_of(spark, sf_dir):
    counted = documents(spark, sf_dir).groupBy(source_number().alias("id")).agg(F.count("*").alias("n"))
    return counted.select("id", (F.col("n") + F.col("id") % 3 - 1).alias("article_count"))


@query(
    "category_counts",
    f"""SELECT c.id, article_count AS expected, n AS found,
        CASE WHEN n < article_count THEN 'FAIL' WHEN n > article_count THEN 'WARN' ELSE 'PASS' END AS status
    FROM {CATEGORIES_SQL} c JOIN (SELECT {SOURCE_NUMBER} AS id, count(*) AS n FROM documents GROUP BY ALL) f ON c.id = f.id""",
)
def category_counts(spark, sf_dir):
    found = documents(spark, sf_dir).select(source_number().alias("category_id"))
    return quality.category_counts(found, categories_of(spark, sf_dir))


def _zero(count: str, level: str) -> str:
    return f"CASE WHEN {count} = 0 THEN 'PASS' ELSE '{level}' END"


@query(
    "quality_articles",
    _checks_sql(
        "articles",
        [
            (
                "article_count",
                "CASE WHEN total < ea THEN 'FAIL' WHEN total > ea THEN 'WARN' ELSE 'PASS' END",
                "total",
                "ea",
            ),
            ("empty_full_articles", _zero("ef", "FAIL"), "ef", "0"),
            ("empty_stubs", "CASE WHEN es > 0 THEN 'WARN' END", "es", "0"),
            ("missing_titles", _zero("nt", "FAIL"), "nt", "0"),
            ("repeated_slugs", _zero("rs", "FAIL"), "rs", "0"),
            ("category_count", "CASE WHEN cats = ec THEN 'PASS' ELSE 'FAIL' END", "cats", "ec"),
            ("stubs", _zero("stubs", "WARN"), "stubs", "0"),
        ],
        f"""SELECT count(*) AS total, count(*) FILTER (WHERE n_chars >= 300 AND text = '') AS ef,
            count(*) FILTER (WHERE n_chars < 300 AND text = '') AS es, 0 AS nt,
            count(text) - count(DISTINCT text) AS rs, count(DISTINCT {SOURCE_NUMBER}) AS cats,
            count(*) FILTER (WHERE n_chars < 300) AS stubs, (SELECT sum(article_count) FROM {CATEGORIES_SQL}) AS ea,
            (SELECT count(*) FROM {CATEGORIES_SQL}) AS ec FROM documents""",
    ),
)
def quality_articles(spark, sf_dir):
    """Slugs are hashes of the texts here, so repeated texts show up as repeated slugs."""
    hashed = texts(spark, sf_dir).select(
        F.sha2("text", 256).alias("slug"),
        say("Document ", F.col("doc_id")).alias("title"),
        F.col("text").alias("content"),
        (F.col("n_chars") < 300).alias("is_stub"),
        source_number().alias("category_id"),
    )
    return quality.check_articles(hashed, quality.expectations(categories_of(spark, sf_dir)))


@query(
    "quality_chunks",
    _checks_sql(
        "chunks",
        [
            ("chunks_present", "CASE WHEN c > 0 THEN 'PASS' ELSE 'WARN' END", "c", "NULL"),
            ("articles_without_chunks", _zero("missing", "FAIL"), "missing", "0"),
            ("chunks_without_vector", _zero("nv", "WARN"), "nv", "0"),
            ("vector_length", _zero("wrong", "FAIL"), "wrong", "0"),
            (
                "average_chunks",
                "CASE WHEN round(c / f, 1) BETWEEN 2 AND 30 THEN 'PASS' ELSE 'WARN' END",
                "round(round(c / f, 1) * 10)",
                "NULL",
            ),
        ],
        """SELECT (SELECT count(*) FROM embeddings) AS c, (SELECT count(*) FROM embeddings WHERE embedding IS NULL) AS nv,
            (SELECT max(vec_id) % 2 FROM embeddings) AS wrong,
            (SELECT count(*) FROM documents WHERE n_chars >= 300) AS f,
            (SELECT count(*) FROM documents WHERE n_chars >= 300 AND doc_id NOT IN (SELECT vec_id FROM embeddings)) AS missing""",
    ),
)
def quality_chunks(spark, sf_dir):
    """The vector of the last id, when that is odd, is made one too short."""
    embeddings = table(spark, sf_dir, "embeddings")
    last = embeddings.agg(F.max("vec_id")).scalar()
    cut = (F.col("vec_id") == last) & (F.col("vec_id") % 2 == 1)
    stored = embeddings.select(
        F.col("vec_id").cast("string").alias("article_id"),
        F.lit(0).alias("chunk_index"),
        F.when(cut, F.slice("embedding", 1, TABLE_DIMENSIONS - 1)).otherwise(F.col("embedding")).alias("embedding"),
    )
    return quality.check_chunks(articles_of(spark, sf_dir), stored, TABLE_DIMENSIONS)


@query(
    "quality_run_verdict",
    """SELECT (SELECT max(vec_id) % 2 = 1 FROM embeddings)
        OR (SELECT count(*) FROM documents WHERE n_chars >= 300 AND doc_id NOT IN (SELECT vec_id FROM embeddings)) > 0
        AS failed""",
)
def quality_run_verdict(spark, sf_dir):
    return quality.run_failed(quality_chunks(spark, sf_dir))


@query(
    "quality_verses",
    _checks_sql(
        "verses",
        [
            ("verses_present", "CASE WHEN b = 0 AND q = 0 THEN 'WARN' END", "b + q", "NULL"),
            ("bible_orphans", _zero("bo", "WARN"), "bo", "0"),
            ("quran_orphans", _zero("qo", "WARN"), "qo", "0"),
            ("surah_range", _zero("bs", "FAIL"), "bs", "0"),
            ("ayah_start", _zero("ba", "FAIL"), "ba", "0"),
            ("chapter", _zero("bc", "FAIL"), "bc", "0"),
            ("verse_start", _zero("bv", "FAIL"), "bv", "0"),
        ],
        """SELECT (SELECT count(*) FROM part) AS b, (SELECT count(*) FROM orders) AS q,
            (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)) AS bo,
            (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS qo,
            (SELECT count(*) FROM orders WHERE o_custkey < 1 OR o_custkey > 114) AS bs,
            (SELECT count(*) FROM orders WHERE o_orderkey % 5 < 1) AS ba,
            (SELECT count(*) FROM part WHERE p_size < 1) AS bc,
            (SELECT count(*) FROM part WHERE p_partkey < 1) AS bv""",
    ),
)
def quality_verses(spark, sf_dir):
    """Parts and orders stand in for the verse tables, line items for the links."""
    bible = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_size").alias("chapter"),
        F.col("p_partkey").alias("verse_start"),
    )
    quran = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").alias("surah"),
        (F.col("o_orderkey") % 5).alias("ayah_start"),
    )
    items = table(spark, sf_dir, "lineitem")
    return quality.check_verses(
        bible,
        quran,
        items.select(F.col("l_partkey").cast("string").alias("verse_id")),
        items.select(F.col("l_orderkey").cast("string").alias("verse_id")),
    )


@query(
    "quality_tally",
    f"""SELECT status, count(*) AS checks FROM (
        SELECT {_zero("count(*) FILTER (WHERE text IS NULL OR text = '')", "FAIL")} AS status FROM documents
        UNION ALL SELECT 'PASS' FROM documents WHERE doc_id = 0
        UNION ALL SELECT CASE WHEN count(*) < ea THEN 'FAIL' WHEN count(*) > ea THEN 'WARN' ELSE 'PASS' END
            FROM documents, (SELECT sum(article_count) AS ea FROM {CATEGORIES_SQL}) GROUP BY ea
        UNION ALL SELECT {_zero("count(*) - count(DISTINCT doc_id)", "FAIL")} FROM documents
        UNION ALL SELECT CASE WHEN count(DISTINCT source) = ec THEN 'PASS' ELSE 'FAIL' END
            FROM documents, (SELECT count(*) AS ec FROM {CATEGORIES_SQL}) GROUP BY ec
        UNION ALL SELECT {_zero("count(*) FILTER (WHERE n_chars < 300)", "WARN")} FROM documents) GROUP BY status""",
)
def quality_tally(spark, sf_dir):
    return quality.tally(quality.check_articles(articles_of(spark, sf_dir), quality.expectations(categories_of(spark, sf_dir))))


@query(
    "audit_contract",
    _checks_sql(
        "audit",
        [
            ("local_rows", "'INFO'", "l", "NULL"),
            ("stored_rows", "'INFO'", "s", "NULL"),
            ("stored_categories", "'INFO'", "c", "NULL"),
            ("only_local", _zero("ol", "FAIL"), "ol", "0"),
            ("only_stored", _zero("os", "FAIL"), "os", "0"),
            ("empty_full", _zero("ef", "FAIL"), "ef", "0"),
            ("empty_stubs", "'INFO'", "es", "NULL"),
        ],
        f"""SELECT (SELECT count(*) FROM labels) AS l, (SELECT count(*) FROM documents) AS s,
            (SELECT count(DISTINCT {SOURCE_NUMBER}) FROM documents) AS c,
            (SELECT count(*) FROM labels ANTI JOIN documents USING (doc_id)) AS ol,
            (SELECT count(*) FROM documents ANTI JOIN labels USING (doc_id)) AS os,
            (SELECT count(*) FROM documents WHERE n_chars >= 300 AND NOT regexp_matches(text, '\\S')) AS ef,
            (SELECT count(*) FROM documents WHERE n_chars < 300 AND NOT regexp_matches(text, '\\S')) AS es""",
    ),
)
def audit_contract(spark, sf_dir):
    local = table(spark, sf_dir, "labels").select(
        say("doc-", F.format_string("%09d", "doc_id")).alias("slug")
    )
    return quality.audit_contract(local, articles_of(spark, sf_dir))


@query(
    "embed_batches",
    """SELECT vec_id, label, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) // 50 AS batch
    FROM embeddings""",
)
def embed_batches(spark, sf_dir):
    from ..operators.ranking import numbered

    stored = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    placed = numbered(stored, ["label"], ["vec_id"], "n")
    return placed.select(
        "vec_id", "label", F.floor((F.col("n") - 1) / chunking.TEXTS_PER_CALL).alias("batch")
    )
