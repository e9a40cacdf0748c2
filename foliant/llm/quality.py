"""A quality classifier: random Fourier features, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, crc_of_id, mapped, staged, text_rows

# Shares of bytes, shares of words and sizes that describe a text.
STATISTICS = (
    "log_chars", "log_words", "word_length", "lower", "upper", "digits", "marks", "high", "pipes",
    "distinct", "adjacent", "top_word", "shouted", "marked_ends", "bare_marks", "longest", "line_words",
    "line_copies", "sentence_words", "odd_marks", "half_copies",
)

_KINDS = np.zeros((6, 256), np.float64)
_KINDS[0, ord("a") : ord("z") + 1] = 1
_KINDS[1, ord("A") : ord("Z") + 1] = 1
_KINDS[2, ord("0") : ord("9") + 1] = 1
_KINDS[3, [c for c in range(33, 127) if not chr(c).isalnum()]] = 1
_KINDS[4, 128:] = 1
_KINDS[5, [ord(c) for c in "#$%&*<>{}=~^+_\\@"]] = 1


def describe(text: str) -> list[float]:
    """The statistics of one text; all are finite, also for an empty one."""
    data = text.encode()
    words = text.split()
    lines = text.split("\n")
    n, size = max(len(words), 1), max(len(data), 1)
    shares = _KINDS @ np.bincount(np.frombuffer(data, np.uint8), minlength=256) / size
    counts = Counter(words)
    top = max(counts.values(), default=0)
    marked = sum(1 for w in words if w[-1] in "!%&#*$|=~")
    bare = sum(1 for w in words if not w[0].isalnum() and len(w) <= 2)
    stops = text.count(".") + text.count("!") + text.count("?")
    half = len(words) // 2
    twice = sum(map(eq, words[:half], words[half:]))
    return [
        np.log1p(len(text)), np.log1p(len(words)), min(len(text) / n, 50.0),
        shares[0], shares[1], shares[2], shares[3], shares[4], text.count("|") / n,
        np.log1p(len(counts)) / np.log1p(n), sum(map(eq, words, words[1:])) / n, top / n,
        sum(map(str.isupper, words)) / n, marked / n, bare / n,
        np.log1p(max(map(len, words), default=0)), min(len(words) / max(len(lines), 1), 500.0) / 100,
        1 - len(set(lines)) / len(lines), min(len(words) / max(stops, 1), 200.0) / 50, shares[5], twice / n,
    ]


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``stats`` of every row's whole text; a null counts as an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("stats", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [describe(t.as_py()) for t in rows.column("text")]
            yield batch(schema, rows.column("doc_id"), found)

    return mapped(text_rows(docs, key, text), run, "doc_id long, stats array<double>")


@dataclass(frozen=True)
class Settings:
    """Features, width of the kernel in standard deviations per statistic, ridge, seed.

    At most ``labelled`` labelled rows take part, chosen by a hash of their id;
    ``steps`` is the number of score steps the calibration distinguishes.
    """

    features: int = 256
    width: float = 1.5
    ridge: float = 1e-4
    seed: int = 7
    labelled: int = 200_000
    steps: int = 5000
    sums: int = 16


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    calibrated: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / self.phases.size)
        return np.hstack([waves, np.ones((len(waves), 1))])

    def ridge_scores(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated, and still rising a little where calibration is flat."""
        raw = self.ridge_scores(stats)
        level = np.interp(raw, self.raw, self.calibrated) if self.raw.size else np.full(raw.size, 0.5)
        return np.clip(0.998 * level + 0.002 / (1 + np.exp(-4 * np.clip(raw - 0.5, -5, 5))), 0, 1)


def pool_adjacent(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to the values in weighted squares."""
    blocks: list[list[float]] = []
    for value, weight in zip(values.tolist(), weights.tolist()):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, k = blocks.pop()
            total = blocks[-1][1] + w
            blocks[-1] = [(blocks[-1][0] * blocks[-1][1] + v * w) / total, total, blocks[-1][2] + k]
    return np.concatenate([np.full(int(k), v) for v, _, k in blocks]) if blocks else np.zeros(0)


def one_label(labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``label`` (0 or 1); of several labels of one id the majority holds, 1 on a tie."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(F.col(key).cast("long").alias("doc_id")).agg(
        (F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label")
    )


def bounded(rows: DataFrame, most: int, total: int) -> DataFrame:
    """About ``most`` of ``total`` rows, chosen by a hash of the id; all when there are fewer."""
    if total <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * most / total))


def fit(described: DataFrame, labels: DataFrame, calibrates: Column, settings: Settings = Settings()) -> Model:
    """Learns from the rows of ``described`` that have a label in ``labels`` (see ``one_label``).

    Every part of the rows adds up its normal equations, and only the sums reach
    the driver.  Rows for which ``calibrates`` holds serve the calibration, the
    others the ridge fit.  Without labels all scores are one half.
    """
    rows = described.join(labels, "doc_id").select("doc_id", "stats", "label", calibrates.alias("calibrates"))
    width = len(STATISTICS)
    total = rows.count()
    rows = staged(bounded(rows, settings.labelled, total).repartition(settings.sums, "doc_id"), "labelled")
    sums = rows.where("NOT calibrates").agg(
        F.count("*").alias("n"),
        *[F.avg(F.get("stats", F.lit(i))).alias(f"m{i}") for i in range(width)],
        *[F.stddev_pop(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(width)],
    ).first()
    random = np.random.default_rng(settings.seed)
    directions = random.standard_normal((width, settings.features)) / (settings.width * np.sqrt(width))
    phases = random.uniform(0, 2 * np.pi, settings.features)
    mean = np.array([sums[f"m{i}"] or 0.0 for i in range(width)])
    scale = np.array([max(sums[f"s{i}"] or 0.0, 1e-6) for i in range(width)])
    none = np.zeros(0)
    start = Model(mean, scale, directions, phases, np.zeros(settings.features + 1), none, none)
    if not sums["n"]:
        return start

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((settings.features + 1,) * 2)
        right, n = np.zeros(settings.features + 1), 0
        for part in batches:
            if part.num_rows:
                x = start.features(_matrix(part, width))
                gram += x.T @ x
                right += x.T @ part.column("label").to_numpy(zero_copy_only=False)
                n += part.num_rows
        schema = pa.schema([("gram", pa.binary()), ("right", pa.binary()), ("n", pa.int64())])
        if n:
            yield batch(schema, [gram.tobytes()], [right.tobytes()], [n])

    parts = mapped(rows.where("NOT calibrates").select("stats", "label"), add_up, "gram binary, right binary, n long")
    gram = np.zeros((settings.features + 1,) * 2)
    right, n = np.zeros(settings.features + 1), 0
    for part in parts.collect():
        gram += np.frombuffer(part["gram"]).reshape(gram.shape)
        right += np.frombuffer(part["right"])
        n += part["n"]
    penalty = np.full(right.size, settings.ridge * n)
    penalty[-1] = 0
    weights = np.linalg.lstsq(gram + np.diag(penalty + 1e-9), right, rcond=None)[0]
    fitted = Model(mean, scale, directions, phases, weights, none, none)
    return _calibrated(fitted, rows.where("calibrates"), rows, settings)


def _calibrated(model: Model, kept: DataFrame, every: DataFrame, settings: Settings) -> Model:
    def ridge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("raw", pa.float64()), ("label", pa.int32())])
        for part in batches:
            yield batch(schema, model.ridge_scores(_matrix(part, len(STATISTICS))), part.column("label"))

    def steps(rows: DataFrame) -> list:
        scored = mapped(rows.select("stats", "label"), ridge, "raw double, label int")
        step = F.round(F.least(F.greatest("raw", F.lit(-1.0)), F.lit(2.0)) * settings.steps / 3)
        return (
            scored.groupBy(step.alias("step"))
            .agg(F.avg("raw").alias("raw"), F.avg("label").alias("label"), F.count("*").alias("n"))
            .orderBy("step").collect()
        )

    found = steps(kept) or steps(every)
    raw, label, n = (np.array([float(r[c]) for r in found]) for c in ("raw", "label", "n"))
    level = pool_adjacent(label, n)
    edge = np.flatnonzero(np.r_[True, level[1:] != level[:-1]])
    at = np.array([np.average(a, weights=b) for a, b in zip(np.split(raw, edge[1:]), np.split(n, edge[1:]))])
    return Model(
        model.mean, model.scale, model.directions, model.phases, model.weights, at, level[edge]
    )


def _matrix(part: pa.RecordBatch, width: int) -> np.ndarray:
    return part.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def score(described: DataFrame, model: Model) -> DataFrame:
    """Adds ``score``, the chance of label 1, to every row of ``described``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in described.schema if f.name != "stats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found = model.scores(_matrix(part, len(STATISTICS)))
            yield part.drop_columns(["stats"]).append_column("score", pa.array(found, pa.float64()))

    return mapped(described, run, f"{fields}, score double")


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), label: str = "quality") -> Model:
    """A model from the labelled rows of ``docs`` alone; see ``score_documents`` for who takes part.

    The chosen ids, ``settings.labelled`` at most, are sent to the texts.
    """
    usable = one_label(labels, label).where(~held_out(F.col("doc_id")))
    chosen = bounded(usable, settings.labelled, usable.count())
    rows = text_rows(docs, "doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id")
    return fit(staged(statistics(rows), "statistics"), chosen, _calibrates(), settings)


def _calibrates() -> Column:
    return F.pmod(crc_of_id(F.col("doc_id")), F.lit(4)) == 3


def score_texts(rows: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Every row with its score put behind; a column of that name is replaced."""
    rows = rows.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            stats = np.array([describe(t.as_py() or "") for t in part.column(text)]).reshape(-1, len(STATISTICS))
            yield part.append_column(name, pa.array(model.scores(stats), pa.float64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return mapped(rows, run, f"{fields}, `{name}` double")


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether an id is kept from learning; a null id, which has no label, is not."""
    return F.coalesce(F.pmod(crc_of_id(doc_id), F.lit(parts)) == part, F.lit(False))


def score_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, settings: Settings = Settings(), label: str = "quality"
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    Of the ids' checksums modulo 4, 2 is kept from learning, 3 calibrates, 0 and 1
    fit.  Only statistics of the whole text enter a score.  Null texts count as
    empty, rows with null ids are scored, repeated rows are scored each.
    """
    described = staged(statistics(docs), "statistics")
    usable = one_label(labels, label).where(~held_out(F.col("doc_id")))
    model = fit(described, usable, _calibrates(), settings)
    return score(described, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
