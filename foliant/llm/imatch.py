"""I-Match fingerprints from terms of middling document frequency, in built-in functions only.

Terms that stand in very few or in very many documents say little about likeness;
what is left of a document is its distinct terms within a band of inverse document
frequency.  A fingerprint holds a hash of these, sorted, and one of each of many
randomised parts of the lexicon: families of ever smaller parts, so that short and
long documents both have parts in which an edit leaves no trace.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, whole_text

# Ranges of ids at most; the table of their first rows is broadcast.
MOST_RANGES = 1 << 17

# Stands for "no term".
NOTHING = 0

# Characters that end a word besides white space.
BREAKS = "\t\n\r\f\u000b.,!?;:|()\"'"

@dataclass(frozen=True)
class Setup:
    """Band of the share of documents that have a term, families of parts, and parts of each.

    A part of level k of a family keeps half the terms of level k - 1; level 0 is
    the whole band.  At most (distinct terms per document on average) / ``least``
    terms can be that frequent, whatever the corpus; this bounds the lexicon.
    """

    least: float = 0.001
    most: float = 0.02
    families: int = 12
    levels: int = 10


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct words of a text, lower-cased."""
    spaced = F.translate(F.lower(text), BREAKS, " " * len(BREAKS))
    words = F.filter(F.split(spaced, " "), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, setup: Setup = Setup(), text: str = "text") -> DataFrame:
    """Column ``term``: hashes of the terms within the band, counted over all documents."""
    counted = docs.select(F.explode(term_hashes(whole_text(text))).alias("term"))
    counted = counted.groupBy("term").agg(F.count("*").alias("documents"))
    total = docs.count()
    return counted.where(
        (F.col("documents") >= setup.least * total) & (F.col("documents") <= setup.most * total)
    ).select("term")


def _hash(terms: Column) -> Column:
    """Null for no terms, else a hash of them in their order."""
    return F.when(F.size(terms) > 0, F.xxhash64(terms))


def _hash_text(text: Column) -> Column:
    """Null for an empty text, else a hash of it in lower case."""
    return F.when(text != "", F.xxhash64(F.lower(text)))


def _bit_is_zero(bit: int) -> Callable[[Column], Column]:
    return lambda t: F.shiftrightunsigned(t, bit).bitwiseAND(F.lit(1).cast("long")) == 0


def part_hashes(df: DataFrame, terms: str, name: str, setup: Setup) -> DataFrame:
    """Adds ``name``: hashes of all parts of the sorted array of terms, null where a part has none.

    Every level filters the level before, which is half as long again.  A hash has
    bits for a few families; the next ones draw on hashes of it.
    """
    found, made = [_hash(F.col(terms))], []
    here = 64 // setup.levels
    rounds = [terms]
    levels = df
    while len(rounds) * here < setup.families:
        levels = levels.withColumn(f"{rounds[-1]}_", F.transform(rounds[-1], lambda t: F.xxhash64(t)))
        rounds.append(f"{rounds[-1]}_")
    levels = levels.withColumns({f"_{name}_{f}_0": F.col(rounds[f // here]) for f in range(setup.families)})
    for level in range(1, setup.levels + 1):
        columns = {}
        for f in range(setup.families):
            bit = f % here * setup.levels + level - 1
            columns[f"_{name}_{f}_{level}"] = F.filter(f"_{name}_{f}_{level - 1}", _bit_is_zero(bit))
        levels = levels.withColumns(columns)
        found += [_hash(F.col(c)) for c in columns]
        made += list(columns)
    dropped = [*rounds[1:], *made, *[f"_{name}_{f}_0" for f in range(setup.families)]]
    return levels.withColumn(name, F.array(*found)).drop(*dropped)


def fingerprint(parts: Column) -> Column:
    """Four hexadecimal digits per part, ``____`` for a part without terms."""
    short = F.transform(
        parts, lambda p: F.coalesce(F.lpad(F.lower(F.hex(p.bitwiseAND(0xFFFF))), 4, "0"), F.lit("____"))
    )
    return F.array_join(short, "")


def likeness(left: Column, right: Column) -> Column:
    """Share of equal parts among those in which either has a term; 1 when neither has any."""
    pairs = F.zip_with(
        left, right,
        lambda a, b: F.when(a.isNull() & b.isNull(), F.lit(None).cast("int")).otherwise(
            F.coalesce((a.bitwiseAND(0xFFFF) == b.bitwiseAND(0xFFFF)).cast("int"), F.lit(0))
        ),
    )
    some = F.filter(pairs, lambda x: x.isNotNull())
    equal = F.aggregate(some, F.lit(0), lambda total, x: total + x)
    return F.when(F.size(some) == 0, F.lit(1.0)).otherwise(equal / F.size(some))


def _with_next(docs: DataFrame, key: str, text: str, rows_per_range: int) -> tuple[DataFrame, list]:
    """Rows by ranges of ids, each range with a guest: the row that follows it in descending order.

    Ids fall into equal ranges, about ``rows_per_range`` rows each when ids are
    dense, and ``MOST_RANGES`` at most; null ids are one more range at the end.
    Guests are found by the keys of the ranges' first rows, which are as many as
    ranges and so may be broadcast; no text is moved for it.
    """
    body = whole_text(text)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("text"))
    limits = rows.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    total, low, high = limits[0], limits[1] or 0, limits[2] or 0
    ranges = min(-(-total // rows_per_range), MOST_RANGES)
    wide = max(1, -(-(high - low + 1) // max(ranges, 1)))
    place = F.coalesce(F.floor((F.col("doc_id") - low) / wide).cast("long"), F.lit(-1).cast("long"))
    rows = rows.withColumn("range", place).withColumn("mark", F.xxhash64("text"))
    firsts = rows.groupBy("range").agg(
        F.min(F.struct((-F.col("doc_id")).alias("down"), "mark")).alias("first")
    )
    around = Window.orderBy(F.desc("range"))
    firsts = firsts.select(
        F.col("first.down").alias("down"), F.col("first.mark").alias("mark"),
        F.coalesce(F.lag("range").over(around), F.min("range").over(Window.partitionBy())).alias("home"),
    )
    guests = (
        rows.join(
            F.broadcast(firsts.withColumnRenamed("mark", "first_mark")),
            (-F.col("doc_id")).eqNullSafe(F.col("down")) & (F.col("mark") == F.col("first_mark")),
        )
        .select("doc_id", "text", F.col("home").alias("range"), "mark", F.lit(True).alias("guest"))
    )
    both = rows.withColumn("guest", F.lit(False)).unionByName(guests)
    order = [F.asc("guest"), F.col("doc_id").desc_nulls_last(), F.asc("mark")]
    return both, order


def fingerprints(
    docs: DataFrame, setup: Setup = Setup(), key: str = "doc_id", text: str = "text", rows_per_range: int = 1024
) -> DataFrame:
    """Fingerprints of every row's text and of its edited text, and how alike they are.

    The edited text has its last half of code points, rounded down, replaced by as
    many first ones of the next row (or all it has) in descending order of id, then
    of a hash of the text; after the last row comes the first.  ``near_edited`` and
    ``near_next`` are the likeness to the edited text and to the next row's text.
    Null texts count as empty and null ids come last.  A text without terms in the
    band is fingerprinted by a hash of the whole text.  Rows with equal texts have equal
    fingerprints.  The lexicon is broadcast; its size has a bound (see ``Setup``).
    """
    rows, order = _with_next(docs, key, text, rows_per_range)
    inside = Window.partitionBy("range").orderBy(*order)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    paired = rows.withColumn("next", F.lead("text").over(inside)).withColumn("row", F.row_number().over(inside))
    edited = F.concat(
        F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half)
    )
    info = F.struct(
        "guest", "doc_id", "mark", n.cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        _hash_text(F.col("text")).alias("all_own"), _hash_text(F.col("edited")).alias("all_other"),
    )
    told = paired.withColumn("edited", edited).select(
        "range", "row", info.alias("info"), term_hashes(F.col("text")).alias("own"),
        term_hashes(F.col("edited")).alias("other"),
    )
    none = F.lit(None).cast(told.schema["info"].dataType)
    # A document's first row carries what else is known of it; its other rows are narrow.
    first = F.struct(F.lit(None).cast("boolean").alias("own"), F.lit(NOTHING).cast("long").alias("term"), F.col("info").alias("info"))

    def narrow(terms: str, own: bool) -> Column:
        return F.transform(
            terms, lambda t: F.struct(F.lit(own).alias("own"), t.alias("term"), none.alias("info"))
        )

    spread = told.select(
        "range", "row", F.explode(F.concat(F.array(first), narrow("own", True), narrow("other", False))).alias("t")
    ).select("range", "row", "t.own", "t.term", "t.info")
    terms = staged(lexicon(docs, setup, text), "lexicon")
    terms = terms.unionAll(docs.sparkSession.range(1).select(F.lit(NOTHING).cast("long").alias("term"))).distinct()
    chosen = spread.join(F.broadcast(terms), "term")
    grouped = chosen.groupBy("range", "row").agg(
        F.first("info", ignorenulls=True).alias("info"),
        F.sort_array(F.collect_list(F.when(F.col("own"), F.col("term")))).alias("own"),
        F.sort_array(F.collect_list(F.when(~F.col("own"), F.col("term")))).alias("other"),
    )
    found = part_hashes(part_hashes(grouped, "own", "parts", setup), "other", "edited_parts", setup)

    def complete(parts: str, everything: str) -> Column:
        """The whole text stands in for the band when it has none of its terms."""
        none = setup.families * setup.levels
        return F.when(
            F.get(parts, F.lit(0)).isNull(),
            F.concat(F.array(f"info.{everything}"), F.array_repeat(F.lit(None).cast("long"), none)),
        ).otherwise(F.col(parts))

    told = found.select(
        "range", "info.*",
        complete("parts", "all_own").alias("parts"), complete("edited_parts", "all_other").alias("edited_parts"),
    )
    last = told.withColumn("next_parts", F.lead("parts").over(inside)).where("NOT guest")
    return last.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("parts")).alias("fingerprint"),
        fingerprint(F.col("edited_parts")).alias("edited_fingerprint"),
        likeness(F.col("parts"), F.col("edited_parts")).alias("near_edited"),
        likeness(F.col("parts"), F.col("next_parts")).alias("near_next"),
    )
