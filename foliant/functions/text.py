"""Trimming, counting and shortening of text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import CASED, TEXT_SPACE, WEB_SPACE

# Markdown symbols that do not count as parts of words.
MARKDOWN_SYMBOLS = r"#*`_~\[\]()>|"

# Reading speed, excerpt length, stub threshold, tokens per word.
WORDS_PER_MINUTE = 200
EXCERPT_CHARS = 150
STUB_WORDS = 50
TOKENS_PER_WORD = 1.3

# Rules a generated method may hold.
LONG_CHAIN = 4

# What plain text drops from markdown, in order.
MARKDOWN_TO_PLAIN = [
    (rf"#{{1,6}}[{WEB_SPACE}]+", "", "#"),
    (r"\*{1,3}([^*]+)\*{1,3}", "$1", "*"),
    (r"\[([^\]]+)\]\([^)]+\)", "$1", "]("),
    (r"`[^`]+`", "", "`"),
    (r"\n+", " ", "\n"),
    (rf"[{WEB_SPACE}]{{2,}}", " "),
]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def rewrite(text: Column, rules: Sequence[tuple[str, ...]]) -> Column:
    """Apply (pattern, replacement) rules one after another.

    A rule may name a third thing: text that every match contains.  Looking for
    it is a plain byte search, and most texts then skip the pattern.

    A long chain would become one generated method too large for the JVM to
    compile, and run many times slower; inside a binding it is evaluated rule by
    rule.
    """

    def apply(value: Column, pattern: str, replacement: str, needs: str = "") -> Column:
        if not needs:
            return F.regexp_replace(value, pattern, replacement)
        return let(
            value,
            lambda v: F.when(
                F.contains(v, F.lit(needs)), F.regexp_replace(v, pattern, replacement)
            ).otherwise(v),
        )

    def chain(value: Column) -> Column:
        for rule in rules:
            value = apply(value, *rule)
        return value

    return let(text, chain) if len(rules) > LONG_CHAIN else chain(text)


def strip_space(text: Column, space: str = TEXT_SPACE) -> Column:
    return F.regexp_replace(text, rf"\A[{space}]++|[{space}]++\z", "")


def is_blank(text: Column, space: str = WEB_SPACE) -> Column:
    """NULL, empty or white space only."""
    return text.isNull() | ~text.rlike(rf"[^{space}]")


def count_words(text: Column, space: str = WEB_SPACE) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{space}]+")), F.lit(0))


def count_content_words(text: Column) -> Column:
    """Words of a body, markdown symbols acting as separators."""
    return F.coalesce(
        F.regexp_count(text, F.lit(rf"[^{WEB_SPACE}{MARKDOWN_SYMBOLS}]+")), F.lit(0)
    )


def is_stub(words: Column) -> Column:
    return words < STUB_WORDS


def estimate_tokens(words: Column) -> Column:
    return F.ceil(words * F.lit(TOKENS_PER_WORD)).cast("int")


def strip_markdown(text: Column) -> Column:
    return strip_space(rewrite(text, MARKDOWN_TO_PLAIN), WEB_SPACE)


def excerpt(text: Column, chars: int = EXCERPT_CHARS) -> Column:
    """Plain text cut at the last whole word within ``chars`` characters."""

    def shortened(plain: Column) -> Column:
        cut = F.regexp_replace(F.substring(plain, 1, chars), r"(?s)(?<=.) [^ ]*\z", "")
        return F.when(F.length(plain) <= chars, plain).otherwise(F.concat(cut, F.lit("…")))

    return let(strip_markdown(text), shortened)


def read_minutes(words: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(words / F.lit(float(WORDS_PER_MINUTE)) + 0.5).cast("int"))


def replace_each(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """Replace every match by a function of it, all in built-in expressions."""

    def replaced(source: Column) -> Column:
        between = F.split(source, pattern, -1)
        matches = F.regexp_extract_all(source, F.lit(pattern), F.lit(0))
        joined = F.zip_with(
            between, matches, lambda gap, match: F.concat(gap, F.coalesce(change(match), F.lit("")))
        )
        return F.array_join(joined, "")

    return let(text, replaced)


def title_case(text: Column) -> Column:
    """Capitalise every run of cased letters, also after apostrophes and digits."""
    return replace_each(
        text,
        rf"[{CASED}]+",
        lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.lower(F.substr(run, F.lit(2)))),
    )
