"""Chunk rows of articles and their vectors."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import chunks
from ..functions.vectors import DIMENSIONS
from .keyed import absent_rows, present_rows

# An embedder answers with (index of the text, vector) pairs, in any order.
Embedder = Callable[[list[str]], list[tuple[int, list[float]]]]

# Texts per call, tries, seconds waited after a first refusal and
# between two calls.
TEXTS_PER_CALL = 50
TRIES = 3
FIRST_WAIT = 5.0
CALL_PAUSE = 0.5


class RateLimited(Exception):
    """The embedding service asks to wait."""


def chunk_articles(articles: DataFrame) -> DataFrame:
    """One row per chunk: article, position from 0, text and token count."""
    listed = articles.select(
        F.col("id").alias("article_id"),
        F.posexplode(chunks.chunk(F.col("title"), F.col("content"))).alias("chunk_index", "content"),
    )
    return listed.withColumn("token_count", chunks.chunk_tokens(F.col("content")))


def pending(articles: DataFrame, stored_chunks: DataFrame, force: bool = False) -> DataFrame:
    """Articles to chunk: no stubs, and without force only those without chunks.

    Ids are compared before any text is read.
    """
    full = articles.where(~F.col("is_stub"))
    if force:
        return full
    stored = stored_chunks.select(F.col("article_id").alias("id"))
    return absent_rows(full, stored, ["id"])


def call_embedder(
    embedder: Embedder, texts: list[str], dimensions: int | None = None, sleep=time.sleep
) -> list[list[float]]:
    """Vectors of the texts, in their order, with retries; a refusal waits, doubling each time.

    An answer must hold every index from 0 once and, where ``dimensions`` is given,
    vectors of that length; another one is an error, so that no text gets the
    vector of a different one.
    """
    for attempt in range(TRIES):
        last = attempt == TRIES - 1
        try:
            answer = sorted(embedder(texts), key=lambda pair: pair[0])
            break
        except RateLimited:
            if last:
                raise
            sleep(FIRST_WAIT * 2**attempt)
        except Exception:
            if last:
                raise
    if [index for index, _ in answer] != list(range(len(texts))):
        raise ValueError(f"{len(texts)} texts were sent, the answer has other indexes")
    if dimensions is not None and any(len(vector) != dimensions for _, vector in answer):
        raise ValueError(f"a vector does not have {dimensions} dimensions")
    return [vector for _, vector in answer]


def embed(
    chunk_rows: DataFrame,
    embedder: Embedder,
    per_call: int = TEXTS_PER_CALL,
    pause: float = CALL_PAUSE,
    dimensions: int | None = None,
) -> DataFrame:
    """Add a vector to every chunk row, a fixed number of texts per call, each call checked."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["content"].tolist()
            vectors: list[list[float]] = []
            for start in range(0, len(texts), per_call):
                if start and pause:
                    time.sleep(pause)
                vectors += call_embedder(embedder, texts[start : start + per_call], dimensions)
            yield batch.assign(embedding=vectors)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunk_rows.schema.fields)
    return chunk_rows.mapInPandas(run, f"{fields}, embedding array<float>")


def refresh(
    articles: DataFrame,
    stored: DataFrame,
    embedder: Embedder,
    force: bool = False,
    dimensions: int | None = None,
    pause: float = CALL_PAUSE,
    partial: bool = False,
) -> DataFrame:
    """The chunk table after a run: chunks of pending articles are replaced, those of all others kept.

    Articles that are gone, and those that are stubs now, lose their chunks; with ``partial`` the
    articles are a part of all, and one that is not among them is not gone.
    Running it again with its own result changes nothing, as nothing is pending.
    """
    due = pending(articles, stored, force)
    fresh = embed(chunk_articles(due), embedder, pause=pause, dimensions=dimensions)
    named = articles.select(F.col("id").alias("article_id"), "is_stub")
    kept = absent_rows(stored, due.select(F.col("id").alias("article_id")), ["article_id"])
    if partial:
        kept = absent_rows(kept, named.where("is_stub"), ["article_id"])
    else:
        kept = present_rows(kept, named.where("NOT is_stub"), ["article_id"]).select(*stored.columns)
    return kept.unionByName(fresh.select(*stored.columns))


def digest_embedder(dimensions: int = DIMENSIONS) -> Embedder:
    """A stand-in without a model: byte pairs of the text's SHA-256 digests as numbers from -1 to 1.

    Digest ``k`` is that of the text with the number ``k`` and a colon before it;
    each gives sixteen numbers.
    """

    def one(text: str) -> list[float]:
        found: list[float] = []
        for k in range(-(-dimensions // 16)):
            digest = hashlib.sha256(f"{k}:{text}".encode()).digest()
            found += [(digest[i] * 256 + digest[i + 1]) / 32768 - 1 for i in range(0, 32, 2)]
        return found[:dimensions]

    return lambda texts: [(i, one(t)) for i, t in enumerate(texts)]


def chunk_averages(chunk_rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Chunks, full articles and chunks per article to one decimal."""
    counts = chunk_rows.select(F.lit(1).alias("c"), F.lit(0).alias("a")).unionAll(
        articles.where(~F.col("is_stub")).select(F.lit(0), F.lit(1))
    )
    return counts.agg(F.sum("c").alias("chunks"), F.sum("a").alias("articles")).select(
        "chunks", "articles", F.round(F.try_divide("chunks", "articles"), 1).alias("average")
    )
