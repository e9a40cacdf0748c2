"""The corpus pipeline: five stages over documents, each one of the operators in ``foliant.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows it gets; its result is
written as Parquet and read again as the next stage's input.  All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import packing, quality, queries, repeats, similar, tokens, toxicity
from foliant.llm.common import new_path, staged

# Words whose ids a worker keeps; its memory is there for the other stages too.
REMEMBERED = 150_000

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Rows below the first score, or from the second score on, go.
GOOD, TOXIC = 0.7, 0.5

# Bytes of a repeated string, and of the anchors that find it.
REPEAT, ANCHORS = 240, (80, 200)

# SQL states neither learned scores nor suffixes; each stage is tested by itself.
ORACLE_SQL = None


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows whose quality score is at least ``GOOD``; null texts count as empty.

    Texts are read for learning, labelled ones only, and for scoring, and never moved.
    """
    rows = _columns(docs)
    model = quality.learn(rows, queries.table(spark, sf_dir, "labels"))
    return _columns(quality.score_texts(rows, model).where(F.col("score") >= GOOD))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows whose toxicity score is below ``TOXIC``."""
    rows = _columns(docs)
    model = toxicity.fit(rows, queries.table(spark, sf_dir, "labels"))
    return _columns(toxicity.score_texts(rows, model).where(F.col("score") < TOXIC))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every group of near copies: five words a shingle, similarity 0.8 or more.

    Similarity is that of the sets of distinct shingles; every link is confirmed by them.  Groups begin
    with the links that ``simhash.link`` finds around its ring; candidates by shared shingles join what is left apart.

    That is the row with the smallest id (a null id comes last), then the smallest hash of
    its text.  Sets are grouped without the texts; the kept rows' keys
    then pick the texts.
    """
    rows = _columns(docs).withColumn("mark", F.xxhash64("doc_id", "text"))
    grouped = similar.near_duplicates(rows)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    kept = grouped.groupBy("root").agg(first).select("first.mark")
    one = rows.join(kept.distinct(), "mark", "left_semi")
    # Rows that agree in id and text are copies too; one of them stays, chosen before rows are moved.
    least = F.min(F.struct("lang", "source", "n_chars", "doc_id", "text")).alias("row")
    return _columns(one.groupBy("mark").agg(least).select("row.*"))


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts what repeated strings of ``REPEAT`` bytes cover, widened to whole characters.

    That is less than fifty words take in any of the languages.  Texts are judged as they come in.  A text of which nothing is left goes;
    ``n_chars`` is counted anew where something was cut.
    """
    done = repeats.remove_repeats(_columns(docs), REPEAT, levels=ANCHORS, whole_characters=True)
    text = F.when(F.col("n_removed") > 0, F.decode("kept", "UTF-8")).otherwise(F.col("text"))
    cut = done.withColumn("text", text)
    cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return _columns(cut.where((F.col("n_removed") == 0) | (F.trim("text") != "")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every piece of every document that is left."""
    counts = tokens.token_counts(_columns(docs), queries.byte_bpe(), remembered=REMEMBERED)
    return packing.pack(staged(counts, "token-counts"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeats_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        done = stage(spark, docs, sf_dir)
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
    return docs
