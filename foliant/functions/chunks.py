"""Token-bounded chunks of an article."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import WEB_SPACE
from .text import TOKENS_PER_WORD, let, count_words, estimate_tokens, strip_space

# Token budgets and the word counts at which they change.
MAX_TOKENS = 700
MEDIUM_TOKENS = 600
MEDIUM_FROM_WORDS = 200
LONG_FROM_WORDS = 2000


def paragraphs(text: Column) -> Column:
    """Trimmed, non-empty pieces between blank lines."""
    return F.filter(
        F.transform(F.split(text, r"\n\n+"), lambda p: strip_space(p, WEB_SPACE)),
        lambda p: p != "",
    )


def words_per_piece(budget: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(budget / F.lit(TOKENS_PER_WORD)).cast("int"))


def hard_split(text: Column, budget: Column) -> Column:
    """Pieces of as many words as fit the budget, joined by single spaces."""
    size = words_per_piece(budget)

    def split(words: Column) -> Column:
        last = F.floor((F.size(words) - 1) / size).cast("int")
        return F.when(
            F.size(words) > 0,
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.array_join(F.slice(words, i * size + 1, size), " "),
            ),
        ).otherwise(F.array().cast("array<string>"))

    return let(F.regexp_extract_all(text, F.lit(rf"[^{WEB_SPACE}]+"), F.lit(0)), split)


def token_budget(words: Column) -> Column:
    medium = (words >= MEDIUM_FROM_WORDS) & (words < LONG_FROM_WORDS)
    return F.when(medium, MEDIUM_TOKENS).otherwise(MAX_TOKENS)


def _pieces(parts: Column, budget: Column) -> Column:
    """Paragraphs with their size; oversized ones already split and marked."""
    piece = "text string, tokens int, whole boolean"

    def one(part: Column) -> Column:
        tokens = estimate_tokens(count_words(part))
        split = F.transform(
            hard_split(part, budget),
            lambda s: F.struct(
                s.alias("text"), F.lit(0).alias("tokens"), F.lit(False).alias("whole")
            ),
        )
        kept = F.struct(part.alias("text"), tokens.alias("tokens"), F.lit(True).alias("whole"))
        return F.when(tokens > budget, split).otherwise(F.array(kept)).cast(
            f"array<struct<{piece.replace(' ', ':').replace(',:', ',')}>>"
        )

    return F.flatten(F.transform(parts, one))


def merge(parts: Column, budget: Column) -> Column:
    """Fill chunks with paragraphs in order, starting a new one on overflow.

    The fold runs over sizes and keeps the places where chunks begin; each chunk's
    text is then put together once.
    """
    start = F.struct(
        F.array().cast("array<int>").alias("starts"),
        F.lit(0).alias("at"),
        F.lit(False).alias("open"),
        F.lit(0).alias("tokens"),
    )

    def step(acc: Column, piece: Column) -> Column:
        at, total = acc["at"] + 1, acc["tokens"] + piece["tokens"]
        fits = acc["open"] & piece["whole"] & (total <= budget)
        return F.struct(
            F.when(fits, acc["starts"]).otherwise(F.array_append(acc["starts"], at)).alias("starts"),
            at.alias("at"),
            piece["whole"].alias("open"),
            F.when(fits, total).when(piece["whole"], piece["tokens"]).otherwise(0).alias("tokens"),
        )

    def joined(pieces: Column) -> Column:
        def one(starts: Column) -> Column:
            def text(first: Column, k: Column) -> Column:
                last = F.coalesce(F.get(starts, k + 1), F.size(pieces) + 1)
                part = F.slice(pieces, first, last - first)
                return F.array_join(F.transform(part, lambda p: p["text"]), "\n\n")

            return F.transform(starts, text)

        sizes = F.transform(pieces, lambda p: F.struct(p["tokens"].alias("tokens"), p["whole"].alias("whole")))
        return let(F.aggregate(sizes, start, step, lambda acc: acc["starts"]), one)

    return let(_pieces(parts, budget), joined)


def prefixed(title: Column, chunk: Column) -> Column:
    return F.concat(F.lit("["), title, F.lit("] - "), strip_space(chunk, WEB_SPACE))


def chunk(title: Column, content: Column) -> Column:
    """Chunk texts of an article, each with the title in front; never empty.

    A chunk that exceeds the bound with its title is split again by the bound
    alone, so a piece may stay a little over it.
    """
    merged = let(
        token_budget(count_words(content)), lambda budget: merge(paragraphs(content), budget)
    )
    raw = let(
        merged,
        lambda m: F.when(F.size(m) > 0, m).otherwise(F.array(strip_space(content, WEB_SPACE))),
    )
    bounded = F.flatten(
        F.transform(
            raw,
            lambda r: F.when(
                estimate_tokens(count_words(prefixed(title, r))) > MAX_TOKENS,
                hard_split(r, F.lit(MAX_TOKENS)),
            ).otherwise(F.array(r)),
        )
    )
    return F.transform(bounded, lambda r: prefixed(title, r))


def chunk_tokens(text: Column) -> Column:
    return estimate_tokens(count_words(text))
