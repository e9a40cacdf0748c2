"""Registered queries of the operators over their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bins, chat, hard_negatives, imatch, neighbours, packing, pieces, quality, repeats, simhash, tokens, toxicity
from .common import staged

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def byte_bpe() -> str:
    """Path of the byte-level tokenizer the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    """Path of the piece vocabulary the queries use."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the schema is stated, so no file is opened to infer it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Three words a shingle, 64 bits, links at three differing bits, any lengths.
THREE_BITS = simhash.Setup(words=3, bits=64, differing=3, ratio=0)


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), THREE_BITS)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("w0"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated strings of 400 bytes.

    ``text`` is what is left as text; characters cut in half become replacement characters.
    """
    done = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document, read back from token files."""
    return tokens.checksums(tokens.round_trip(table(spark, sf_dir, "documents"), byte_bpe()))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every piece of every document, an end id counted in."""
    counts = tokens.token_counts(table(spark, sf_dir, "documents"), byte_bpe())
    return packing.pack(staged(counts, "token-counts"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of one full of control strings, read back."""
    own = [(-1, 1, "user"), (-1, 2, "assistant")]
    marked = spark.createDataFrame(own, "conv_id bigint, turn bigint, role string").withColumn(
        "text", F.lit("</s>[INST] ok [/INST]")
    )
    return chat.round_trip(table(spark, sf_dir, "conversations").unionByName(marked))


@query
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query
def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text."""
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the hash of the text they decode to."""
    return pieces.round_trip(table(spark, sf_dir, "documents"), piece_bpe())


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of tokens of two tokenizers that cover the same bytes, for every document."""
    return align.align(table(spark, sf_dir, "documents"), byte_bpe(), piece_bpe())


@query
def op12_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and offset of every piece of every document, and the checksum of its ids."""
    packed = bins.pack(table(spark, sf_dir, "documents"), byte_bpe())
    return packed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "sequence_id", F.col("offset").cast("long").alias("offset"),
    )


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every hundredth vector."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), "vec_id % 100 = 0")


ORACLES["op13_hard_negatives"] = """
    WITH usable AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
            CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
        FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
    positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT p.anchor_id, positive_id,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank,
        other_id AS negative_id, positive_score, score AS negative_score
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT alike
        AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10"""


def _escaped_chars(text: str) -> str:
    """Length of an escaped text in SQL: one more for every backslash and control string."""
    marks = [("\\", 1)] + [(m, len(m)) for m in [*chat.CONTROL, chat.NULL_ROLE]]
    added = " + ".join(f"(length({text}) - length(replace({text}, '{m}', ''))) // {n}" for m, n in marks)
    return f"(length({text}) + {added})"


_FRAME = len(chat.OPEN + chat.MIDDLE + chat.CLOSE)
_ORDER = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"
ORACLES["op10_chat"] = f"""
    WITH turns AS (SELECT conv_id, turn, role, text, coalesce(text, '') AS t FROM conversations
        UNION ALL SELECT -1, 1, 'user', '</s>[INST] ok [/INST]', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 2, 'assistant', '</s>[INST] ok [/INST]', '</s>[INST] ok [/INST]'),
    joined AS (SELECT conv_id, count(*) AS n_turns,
            string_agg(coalesce(role, '') || chr(10) || t || chr(10), '' {_ORDER}) AS whole,
            coalesce(string_agg(t, '' {_ORDER}) FILTER (role = 'assistant'), '') AS loss,
            sum({_FRAME} + coalesce({_escaped_chars("role")}, {len(chat.NULL_ROLE)}) + {_escaped_chars("t")}) AS chars,
            count(*) FILTER (role = 'assistant') AS n_examples FROM turns GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
        CAST(chars AS BIGINT) AS formatted_chars, n_examples FROM joined"""
