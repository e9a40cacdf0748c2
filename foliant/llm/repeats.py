"""Removal of long strings that occur more than once anywhere in a corpus.

Every string of ``length`` bytes holds an anchor: the shorter string inside it
with the smallest hash.  Equal strings hold equal anchors, so only texts around
one anchor need to be compared; they go to one shard, where threshold-bounded
expansion on a Burrows-Wheeler transform finds the strings that really repeat.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bwt
from .common import batch, discard, mapped, staged, whole_text

# Bytes of a repeated string, and of the anchors of each level.  The last level's
# anchors are the strings themselves.
LENGTH = 400
ANCHORS = (128, 336)

# Bytes that one anchor's shard may hold, and that one transform is built over.
GROUP_BYTES = 8 << 20
SHARD_BYTES = 1 << 18

# Bytes of text that are hashed at a time.
HASHED_BYTES = 1 << 21

_BASE = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def rolling_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` bytes, from hashes of runs of doubling lengths."""
    span, part = 1, data.astype(np.uint64) + np.uint64(1)
    whole, done = None, 0
    while span <= size:
        if size & span:
            if whole is None:
                whole = part
            else:
                kept = min(whole.size, part.size - done)
                factor = np.uint64(pow(_BASE, span, 1 << 64))
                whole = whole[:kept] * factor + part[done : done + kept]
            done += span
        if span * 2 <= size:
            factor = np.uint64(pow(_BASE, span, 1 << 64))
            part = part[:-span] * factor + part[span:]
        span *= 2
    whole = whole[: data.size - size + 1]
    whole = (whole ^ (whole >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return whole ^ (whole >> np.uint64(29))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    span, least = 1, values
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[: least.size - rest], least[rest:]) if rest else least


def anchors(data: np.ndarray, offsets: np.ndarray, size: int, length: int):
    """Anchors of texts laid end to end: text, hash, start and end of what they stand for.

    ``offsets`` has the start of every text and the end of the last.  Every string
    of ``length`` bytes inside a text lies inside the span of an anchor with the
    least hash it holds.  Equal anchors of one text whose spans share such strings
    become one; the last array marks these, as a string may repeat inside them.
    """
    none = np.zeros(0, np.int64)
    if data.size < length:
        return none, none.astype(np.uint64), none, none, none.astype(bool)
    width = length - size + 1
    hashes = rolling_hashes(data, size)
    least = sliding_least(hashes, width)
    # Strings that would reach into the next text do not count.
    step = np.zeros(data.size + 2, np.int8)
    sizes = np.diff(offsets)
    long_ = sizes >= length
    np.add.at(step, offsets[:-1][long_], 1)
    np.add.at(step, (offsets[1:][long_] - length + 1), -1)
    valid = np.cumsum(step[: least.size], dtype=np.int8) > 0
    change = np.r_[True, (least[1:] != least[:-1]) | ~valid[:-1]]
    first = np.flatnonzero(valid & change)
    if not first.size:
        return none, none.astype(np.uint64), none, none, none.astype(bool)
    last = np.flatnonzero(valid & np.r_[change[1:] | ~valid[1:], True])
    found = []
    while first.size:
        place = np.empty(first.size, np.int64)
        for low in range(0, first.size, 4096):
            part = first[low : low + 4096]
            seen = hashes[part[:, None] + np.arange(width)] == least[part][:, None]
            place[low : low + 4096] = part + width - 1 - np.argmax(seen[:, ::-1], axis=1)
        found.append(place)
        more = place < last
        first, last = place[more] + 1, last[more]
    place = np.unique(np.concatenate(found))
    text = np.searchsorted(offsets, place, side="right") - 1
    begin, end = offsets[text], offsets[text + 1]
    twin = np.zeros(place.size, bool)
    for low in range(0, place.size, 4096):
        part = slice(low, low + 4096)
        for way in (1, -1):
            at = place[part, None] + way * np.arange(1, width)
            inside = (at >= begin[part, None]) & (at + size <= end[part, None])
            same = hashes[np.clip(at, 0, hashes.size - 1)] == hashes[place[part]][:, None]
            twin[part] |= (inside & same).any(axis=1)
    mark = hashes[place]
    by = np.lexsort((place, mark, text))
    text, mark, place, twin = text[by], mark[by], place[by], twin[by]
    joined = (text[1:] == text[:-1]) & (mark[1:] == mark[:-1]) & (place[1:] - place[:-1] < width)
    new = np.flatnonzero(np.r_[True, ~joined])
    start = np.maximum(place[new] - (width - 1), offsets[text[new]])
    stop = place[np.r_[new[1:], place.size] - 1] + length
    stop = np.minimum(stop, offsets[text[new] + 1])
    return text[new], mark[new], start, stop, np.logical_or.reduceat(twin, new)


_ANCHORS = pa.schema(
    [
        ("g", pa.int64()), ("ctx", pa.int64()), ("scope", pa.int64()), ("unit", pa.int64()),
        ("size", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()),
        ("copies", pa.int64()), ("twin", pa.bool_()),
    ]
)
_ANCHORS_SQL = (
    "g long, ctx long, scope long, unit long, size int, start int, stop int, copies long, twin boolean"
)


def _anchor_rows(anchor: int, length: int):
    def rows_of(group: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(x[3] for x in group), np.uint8)
        sizes = np.fromiter((len(x[3]) for x in group), np.int64, len(group))
        offsets = np.r_[0, np.cumsum(sizes)]
        text, mark, start, stop, twin = anchors(data, offsets, anchor, length)
        scope, unit, copies = (
            np.fromiter((x[i] for x in group), np.int64, len(group))[text] for i in range(3)
        )
        g = ((mark ^ (scope.view(np.uint64) * np.uint64(_BASE))) * np.uint64(_BASE | 2)).view(np.int64)
        view = memoryview(data)
        around = np.fromiter(
            (xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(start.tolist(), stop.tolist())),
            np.uint64, start.size,
        )
        base = offsets[text]
        return batch(
            _ANCHORS, g, around.view(np.int64), scope, unit, sizes[text].astype(np.int32),
            (start - base).astype(np.int32), (stop - base).astype(np.int32), copies, twin,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = [], 0
        for rows in batches:
            for scope, unit, copies, data in zip(
                *(rows.column(c).to_pylist() for c in ("scope", "unit", "copies")), rows.column("data")
            ):
                data = data.as_py()
                if len(data) < length:
                    continue
                group.append((scope, unit, copies, data))
                held += len(data)
                if held >= HASHED_BYTES:
                    yield rows_of(group)
                    group, held = [], 0
        if group:
            yield rows_of(group)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around chosen anchors; rows of one unit that follow each other give them once."""
    last = None
    schema = pa.schema([("g", pa.int64()), ("ctx", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
    for rows in batches:
        units = zip(*(rows.column(c).to_pylist() for c in ("scope", "unit", "size")))
        for unit, data, wanted in zip(units, rows.column("data"), rows.column("wanted")):
            if unit == last:
                continue
            last = unit
            view, wanted = memoryview(data.as_buffer()), wanted.as_py()
            for low in range(0, len(wanted), 4096):
                part = wanted[low : low + 4096]
                yield batch(
                    schema, [w["g"] for w in part], [w["ctx"] for w in part], [w["n"] for w in part],
                    [bytes(view[w["start"] : w["stop"]]) for w in part],
                )


_RANGES = pa.schema([("g", pa.int64()), ("ctx", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])
_RANGES_SQL = "g long, ctx long, low int, high int"


def _shards(length: int):
    """Repeated ranges of contexts that come sorted by anchor and context; equal ones count once."""

    def ranges_of(group: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        g = np.fromiter((x[0] for x in group), np.int64, len(group))
        flags, offsets = bwt.repeated_starts([x[2] for x in group], g, length)
        low, high = bwt.covered(flags, length)
        text = np.searchsorted(offsets, low, side="right") - 1
        ctx = np.fromiter((x[1] for x in group), np.int64, len(group))
        base = offsets[text]
        return batch(
            _RANGES, g[text], ctx[text], (low - base).astype(np.int32), (high - base).astype(np.int32)
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[int, int, bytes]] = []
        held = 0
        for rows in batches:
            for g, ctx, data in zip(*(rows.column(c).to_pylist() for c in ("g", "ctx", "data"))):
                if group and group[-1][:2] == (g, ctx):
                    continue
                # A transform begins only with a new anchor, so none is split.
                if held >= SHARD_BYTES and group[-1][0] != g:
                    yield ranges_of(group)
                    group, held = [], 0
                group.append((g, ctx, data))
                held += len(data)
        if group:
            yield ranges_of(group)

    return run


def repeated_ranges(
    texts: DataFrame,
    length: int,
    levels: Sequence[int] = ANCHORS,
    group_bytes: int = GROUP_BYTES,
    held: list[DataFrame] | None = None,
) -> DataFrame:
    """Ranges of bytes covered by repeated strings, by ``scope``, ``unit`` and ``size``.

    ``texts`` has ``scope``, ``unit``, ``copies`` and ``data``; strings repeat only
    within a scope.  Equal surroundings of an anchor are compared once; those that
    occur twice are repeated as a whole.  An anchor with more distinct surroundings
    than ``group_bytes`` gets longer anchors inside them; at the last level these
    are the strings themselves, and counting them replaces the transform.  So no
    anchor, however common, makes a shard without bound, and none is left out.
    Staged tables that the result reads are added to ``held``, to be discarded after it.
    """
    held = [] if held is None else held
    anchor, *rest = levels or (length,)
    found = staged(mapped(texts, _anchor_rows(anchor, length), _ANCHORS_SQL), "anchors")
    place = F.struct("scope", "unit", "size", "start", "stop")
    contexts = found.groupBy("g", "ctx").agg(
        F.sum("copies").alias("n"), F.max("twin").alias("twin"), F.min(place).alias("at")
    )
    wide = F.col("at.stop") - F.col("at.start")
    groups = contexts.groupBy("g").agg(
        F.count("*").alias("kinds"), F.max("n").alias("most"), F.sum(wide.cast("long")).alias("bytes"),
        F.max("twin").alias("any_twin"),
    ).where("kinds > 1 OR most > 1 OR any_twin")
    judged = staged(contexts.join(groups, "g"), "contexts")
    held += [found, judged]
    whole = judged.where("n > 1").select(
        "g", "ctx", F.lit(0).alias("low"), wide.cast("int").alias("high")
    )
    open_ = judged.where("kinds > 1 OR (twin AND n = 1)")
    wanted = open_.groupBy("at.scope", "at.unit", "at.size").agg(
        F.collect_list(
            F.struct("g", "ctx", "n", "bytes", F.col("at.start").alias("start"), F.col("at.stop").alias("stop"))
        ).alias("wanted")
    )
    sized = texts.withColumn("size", F.length("data"))
    near = F.filter("wanted", lambda w: w["bytes"] <= group_bytes)
    far = F.filter("wanted", lambda w: w["bytes"] > group_bytes)

    def surroundings(which: Column) -> DataFrame:
        chosen = wanted.withColumn("wanted", which).where(F.size("wanted") > 0)
        joined = sized.join(chosen, ["scope", "unit", "size"]).select("scope", "unit", "size", "data", "wanted")
        return mapped(joined, _cut, "g long, ctx long, n long, data binary")

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts_ranges = [whole]
    if levels:
        shards = surroundings(near).repartition(parts, "g").sortWithinPartitions("g", "ctx")
        parts_ranges.append(mapped(shards, _shards(length), _RANGES_SQL))
        if not judged.where(F.col("bytes") > group_bytes).isEmpty():
            inner = surroundings(far).select(
                F.col("g").alias("scope"), F.col("ctx").alias("unit"), F.col("n").alias("copies"), "data"
            )
            inner = staged(inner, "surroundings")
            held.append(inner)
            deeper = repeated_ranges(inner, length, rest, group_bytes, held)
            parts_ranges.append(
                deeper.select(F.col("scope").alias("g"), F.col("unit").alias("ctx"), "low", "high")
            )
    ranges = parts_ranges[0]
    for more in parts_ranges[1:]:
        ranges = ranges.unionByName(more)
    return (
        found.join(ranges, ["g", "ctx"])
        .select(
            "scope", "unit", "size",
            (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"),
        )
        .distinct()
    )


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    key: str = "doc_id",
    text: str = "text",
    levels: Sequence[int] = ANCHORS,
    group_bytes: int = GROUP_BYTES,
    whole_characters: bool = False,
) -> DataFrame:
    """Every row without the bytes that a repeated string of ``length`` bytes covers.

    Strings are judged on the input, inside one text or between two, and may
    overlap; they never run from one text into the next.  Result columns are
    those of the input with ``kept`` (binary), ``n_bytes``, ``n_removed`` and
    ``spans`` (maximal removed ranges of bytes) put behind; input columns of these
    names are replaced.  With ``whole_characters`` ranges are widened to the bytes of
    whole characters, so that what is left is text.  Null texts count as empty, shorter texts keep all bytes,
    and repeated rows are repeats of each other.  Columns of the input are only
    passed through.
    """
    data = F.encode(whole_text(text), "UTF-8")
    unit = F.xxhash64(F.coalesce(F.col(key).cast("long"), F.lit(-1)), data)
    units = docs.select(
        F.lit(0).cast("long").alias("scope"), unit.alias("unit"), F.lit(1).cast("long").alias("copies"),
        data.alias("data"),
    )
    held: list[DataFrame] = []
    ranges = repeated_ranges(units, length, levels, group_bytes, held)
    spans = staged(
        ranges.groupBy("unit", "size").agg(F.collect_list(F.struct("low", "high")).alias("ranges")), "ranges"
    )
    discard(*held)
    spans = spans.select(F.col("unit").alias("_unit"), F.col("size").alias("_size"), F.col("ranges").alias("_ranges"))
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    own = F.encode(F.coalesce(F.col(f"_row.`{text}`").cast("string"), F.lit("")), "UTF-8")
    row = row.withColumn("_data", own).withColumn(
        "_unit", F.xxhash64(F.coalesce(F.col(f"_row.`{key}`").cast("long"), F.lit(-1)), "_data")
    )
    row = row.withColumn("_size", F.length("_data"))
    joined = row.join(spans, ["_unit", "_size"], "left").select("_row", "_data", "_ranges")
    row_type = joined.schema["_row"].dataType
    done = mapped(
        joined, _without(whole_characters),
        f"_row {row_type.simpleString()}, kept binary, n_bytes long, n_removed long, "
        "spans array<struct<low: int, high: int>>",
    )
    new = ["kept", "n_bytes", "n_removed", "spans"]
    return done.select(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in new], *new)


def _without(whole_characters: bool):
    names = ["_row", "kept", "n_bytes", "n_removed", "spans"]
    span = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))

    def widened(data: bytes, low: int, high: int) -> tuple[int, int]:
        while whole_characters and 0 < low < len(data) and data[low] & 0xC0 == 0x80:
            low -= 1
        while whole_characters and high < len(data) and data[high] & 0xC0 == 0x80:
            high += 1
        return low, high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            kept, sizes, removed, spans = [], [], [], []
            for data, ranges in zip(rows.column("_data"), rows.column("_ranges")):
                view, merged = data.as_py(), []
                for low, high in sorted(widened(view, r["low"], r["high"]) for r in ranges.as_py() or ()):
                    if merged and low <= merged[-1]["high"]:
                        merged[-1]["high"] = max(high, merged[-1]["high"])
                    else:
                        merged.append({"low": low, "high": high})
                edges = [0, *(x for r in merged for x in (r["low"], r["high"])), len(view)]
                kept.append(b"".join(view[a:b] for a, b in zip(edges[::2], edges[1::2])))
                sizes.append(len(view))
                removed.append(len(view) - len(kept[-1]))
                spans.append(merged)
            arrays = [
                rows.column("_row"), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()), pa.array(spans, span),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run
