"""Toxicity by a weighted grammar over clauses.

Words become classes (insult, threat, target, negation, report, quote, other); a
chain of finite-state transducers, composed into one, then rewrites the classes
of a clause: insults in the scope of a negation, in reported speech and at a
target become different events, each with a weight.  What counts is the clause,
not the word.  Which words insult is learned from labels, by whole words and by
beginnings of words; a logistic function turns the events of a text into a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, crc_of_id, mapped, staged, text_rows
from .quality import one_label

# Words of the closed classes in four languages.
THREATS = """kill hurt destroy murder stab shoot strangle burn beat smash hang töten umbringen schlagen
vernichten erschießen tuer tuerai frapper détruire brûler matar golpear destruir quemar""".split()
TARGETS = """you your yours yourself he she they them him her this these those du dich dir dein deine sie
ihr euch er diese dieser tu toi te vous ton il elle ils elles ces cette tú ti usted ustedes él ella ellos
ellas esos este esta""".split()
NEGATIONS = """not no never isn aren wasn don doesn didn won cannot nicht kein keine keinen nie niemals ne
pas jamais nunca jamás ni""".split()
REPORTS = """said says say wrote writes told claims claimed called quoted quotes according sagte sagt schrieb
behauptet dit écrit selon affirme dijo dice escribió según""".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END = range(8)

# Events a clause may hold, with their weights in its score (fixed values).
EVENTS = ("plain", "aimed", "negated", "reported", "threat", "loose_threat")
WEIGHTS = (1.0, 1.5, 0.3, 0.5, 1.2, 0.2)

# Words a negation reaches.
REACH = 3

# Lengths of the beginnings of words the lexicon may hold.
PREFIXES = range(3, 9)

TOKEN = re.compile(r"""[^\W\d_]+|[.!?;\n"«»„“”]""")


@dataclass
class Transducer:
    """A deterministic transducer: (state, symbol) leads to (state, symbols)."""

    arcs: dict[tuple, tuple] = field(default_factory=dict)
    start: object = 0

    def then(self, other: Transducer, symbols: range) -> Transducer:
        """The composition: what this one writes, the other one reads."""
        start = (self.start, other.start)
        arcs, todo, seen = {}, [start], {start}
        while todo:
            state = todo.pop()
            for symbol in symbols:
                inner, written = self.arcs[state[0], symbol]
                outer, out = state[1], ()
                for s in written:
                    outer, more = other.arcs[outer, s]
                    out += more
                arcs[state, symbol] = ((inner, outer), out)
                if (inner, outer) not in seen:
                    seen.add((inner, outer))
                    todo.append((inner, outer))
        return Transducer(arcs, start)

    def numbered(self) -> list[list[tuple[int, tuple]]]:
        """The same as a table, the start being state 0."""
        ids = {self.start: 0}
        for state, _ in self.arcs:
            ids.setdefault(state, len(ids))
        width = 1 + max(symbol for _, symbol in self.arcs)
        table: list[list] = [[None] * width for _ in ids]
        for (state, symbol), (after, out) in self.arcs.items():
            table[ids[state]][symbol] = (ids[after], out)
        return table


# Symbols between the transducers, behind the classes of words.
NEG_INSULT, NEG_THREAT, REP_INSULT, REP_THREAT = range(8, 12)


def negation() -> Transducer:
    """Marks insults and threats at most ``REACH`` words behind a negation."""
    arcs = {}
    for left in range(REACH + 1):
        for symbol in range(END):
            after = REACH if symbol == NEGATION else max(left - 1, 0)
            out = {INSULT: NEG_INSULT, THREAT: NEG_THREAT}.get(symbol, symbol) if left else symbol
            arcs[left, symbol] = (after, (out,))
    return Transducer(arcs)


def reported_speech() -> Transducer:
    """Marks what stands between quotes or behind a verb of saying."""
    arcs = {}
    for state in ("own", "said", "quoted"):
        for symbol in [*range(END), NEG_INSULT, NEG_THREAT]:
            after = state
            if symbol == QUOTE:
                after = "own" if state == "quoted" else "quoted"
            elif symbol == REPORT and state == "own":
                after = "said"
            out = symbol if state == "own" else {INSULT: REP_INSULT, THREAT: REP_THREAT}.get(symbol, symbol)
            arcs[state, symbol] = (after, (out,))
    return Transducer(arcs, "own")


def aim() -> Transducer:
    """Writes events; an insult is aimed when its clause has a target on either side.

    ``-1`` turns the last plain insult into an aimed one.
    """
    plain, aimed, negated, reported, threat, loose = range(len(EVENTS))
    arcs = {}
    for state in ("nobody", "open", "somebody"):
        there = state == "somebody"
        for symbol in [*range(END), NEG_INSULT, NEG_THREAT, REP_INSULT, REP_THREAT]:
            after, out = state, ()
            if symbol == TARGET:
                after, out = "somebody", (-1,) if state == "open" else ()
            elif symbol == INSULT:
                after, out = (state, (aimed,)) if there else ("open", (plain,))
            elif symbol == THREAT:
                out = (threat if there else loose,)
            elif symbol in (NEG_INSULT, NEG_THREAT):
                out = (negated,)
            elif symbol in (REP_INSULT, REP_THREAT):
                out = (reported,)
            arcs[state, symbol] = (after, out)
    return Transducer(arcs, "nobody")


def grammar() -> list[list[tuple[int, tuple]]]:
    first = negation().then(reported_speech(), range(END))
    return first.then(aim(), range(END)).numbered()


@dataclass(frozen=True)
class Settings:
    """Bounds and thresholds of learning.

    At most ``labelled`` rows of each label take part, chosen by a hash of their
    id.  A form enters the lexicon when it stands in ``share`` of the toxic texts
    and at least ``least`` of them, beside ``contexts`` different words, and is
    ``times`` as frequent in toxic texts as in others; the ``forms`` strongest stay.
    """

    labelled: int = 8000
    share: float = 0.002
    least: int = 4
    contexts: int = 4
    times: float = 20.0
    forms: int = 20_000
    held_forms: int = 200_000
    ridge: float = 1e-3


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: np.ndarray

    def scores(self, events: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(events) @ self.weights, -30, 30)))


def _design(events: np.ndarray) -> np.ndarray:
    return np.hstack([np.log1p(events), np.ones((len(events), 1))])


# Of each text: weight of every kind of event, best clause, matched clauses, matched per 100 words.
FEATURES = len(EVENTS) + 3


class Reader:
    """Finds the events of texts with a lexicon; words met before are looked up."""

    def __init__(self, lexicon: dict[str, float], remembered: int = 200_000):
        self.lexicon, self.remembered, self.table = lexicon, remembered, grammar()
        self.closed = {w: QUOTE for w in '"«»„“”'} | {w: END for w in ".!?;\n"}
        for words, kind in ((REPORTS, REPORT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (THREATS, THREAT)):
            self.closed |= dict.fromkeys(words, kind)
        self.known: dict[str, int] = {}
        self.weight: dict[str, float] = {}

    def strength(self, word: str) -> float:
        """Weight of the strongest form of the word in the lexicon, 0 without one."""
        found = [self.lexicon.get(word + "$", 0.0)]
        found += [self.lexicon.get(word[:k], 0.0) for k in PREFIXES if len(word) >= k]
        return max(found)

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > self.remembered:
            self.known.clear()
        for word in words:
            strength = self.strength(word) if len(word) > 1 else 0.0
            if strength:
                self.weight[word] = strength
            self.known[word] = INSULT if strength else self.closed.get(word, OTHER)

    def events(self, text: str) -> list[float]:
        tokens = TOKEN.findall(text.lower())
        fresh = {t for t in tokens if t not in self.known}
        if len(self.known) + len(fresh) > self.remembered:
            fresh = set(tokens)
        if fresh:
            self.learn(fresh)
        kinds = bytes(map(self.known.__getitem__, tokens))
        sums, best, matched, at = [0.0] * len(EVENTS), 0.0, 0, 0
        for clause in kinds.split(bytes([END])):
            if INSULT in clause or THREAT in clause:
                score = self.clause(clause, tokens[at : at + len(clause)], sums)
                best, matched = max(best, score), matched + (score > 0)
            at += len(clause) + 1
        return [*sums, best, float(matched), 100.0 * matched / max(len(tokens), 20)]

    def clause(self, kinds: bytes, tokens: list[str], sums: list[float]) -> float:
        """Adds the clause's events to ``sums``; its score comes back."""
        state, score, last = 0, 0.0, 0.0
        for kind, token in zip(kinds, tokens):
            state, written = self.table[state][kind]
            for event in written:
                if event < 0:
                    sums[0] -= last
                    sums[1] += last
                    score += (WEIGHTS[1] - WEIGHTS[0]) * last
                    continue
                last = self.weight.get(token, 1.0)
                sums[event] += last
                score += WEIGHTS[event] * last
        return score


def _forms(text: str) -> dict[str, int]:
    """Forms of the words of a text, each with a bit for every word before it, hashed to 64."""
    words = TOKEN.findall(text.lower())
    seen: dict[str, int] = {}
    for word, before in dict(zip(words, ["", *words])).items():
        if len(word) < 2:
            continue
        bit = 1 << (sum(before.encode()) * 7 + len(before)) % 63
        seen[word + "$"] = seen.get(word + "$", 0) | bit
        for k in PREFIXES:
            if len(word) < k:
                break
            seen[word[:k]] = seen.get(word[:k], 0) | bit
    return seen


def learn_lexicon(rows: DataFrame, settings: Settings) -> dict[str, float]:
    """Forms that mark toxic texts, with their weights; ``rows`` has ``text`` and ``label``."""
    schema = pa.schema(
        [("form", pa.string()), ("toxic", pa.int64()), ("other", pa.int64()), ("contexts", pa.int64())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}

        def out() -> pa.RecordBatch:
            made = batch(schema, list(found), *map(list, zip(*found.values())))
            found.clear()
            return made

        for part in batches:
            for text, label in zip(part.column("text"), part.column("label").to_pylist()):
                for form, bits in _forms(text.as_py()).items():
                    entry = found.setdefault(form, [0, 0, 0])
                    entry[1 - label] += 1
                    if label:
                        entry[2] |= bits
                if len(found) > settings.held_forms:
                    yield out()
        if found:
            yield out()

    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, other = totals.get(1, 0), totals.get(0, 0)
    if not toxic:
        return {}
    counted = mapped(rows.select("text", "label"), count, "form string, toxic long, other long, contexts long")
    summed = counted.groupBy("form").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.bit_or("contexts").alias("contexts")
    )
    ratio = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("other") + 0.5) / (other + 1))
    chosen = summed.where(
        (F.col("toxic") >= max(settings.least, settings.share * toxic))
        & (F.bit_count("contexts") >= settings.contexts) & (ratio >= settings.times)
    ).select("form", F.log(ratio).alias("weight"))
    kept = chosen.orderBy(F.desc("weight"), "form").limit(settings.forms).collect()
    return {r["form"]: r["weight"] for r in kept}


def event_table(rows: DataFrame, lexicon: dict[str, float], *more: str) -> DataFrame:
    """``events`` of the whole ``text`` of every row, and the named columns."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*more).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for part in batches:
            found = [reader.events(t.as_py()) for t in part.column("text")]
            events = pa.array(found, pa.list_(pa.float64()))
            yield part.drop_columns(["text"]).append_column("events", events)

    return mapped(rows.select(*more, "text"), run, f"{fields}, events array<double>")


def logistic(events: np.ndarray, labels: np.ndarray, ridge: float) -> np.ndarray:
    """Weights by Newton steps on the bounded sample; rows of both labels weigh alike in sum."""
    x = _design(events)
    if not len(labels) or labels.min() == labels.max():
        weights = np.zeros(x.shape[1])
        weights[-1] = 0.0 if not len(labels) else (2.0 if labels[0] else -2.0)
        return weights
    weights, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge * len(labels))
    penalty[-1] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - labels) + penalty * weights
        hessian = (x.T * (p * (1 - p))) @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        weights = weights - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    return weights


def held_out(doc_id: Column) -> Column:
    """Whether an id is kept from learning; a null id, which has no label, is not."""
    return F.coalesce(F.pmod(crc_of_id(doc_id), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), label: str = "toxic",
        key: str = "doc_id", text: str = "text") -> Model:
    """Learns lexicon and weights; of the ids' checksums modulo 5, 0 takes no part.

    Remainders 1 and 2 give the lexicon and 3 and 4 the weights, so that the
    weights are not learned from words known by heart.  Without toxic labels the
    lexicon is empty and only threats are found.
    """
    usable = one_label(labels, label).where(~held_out(F.col("doc_id")))
    sizes = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    cut = F.lit(1 << 20)
    for value, n in sizes.items():
        limit = int((1 << 20) * min(1.0, settings.labelled / n))
        cut = F.when(F.col("label") == value, limit).otherwise(cut)
    chosen = usable.where(place < cut)
    # At most about twice ``labelled`` ids, so they go to the texts and not the texts to them.
    rows = text_rows(docs, key, text).join(F.broadcast(chosen), "doc_id")
    rows = staged(rows.withColumn("words", F.pmod(crc_of_id(F.col("doc_id")), F.lit(5)) <= 2), "labelled")
    parts = docs.sparkSession.sparkContext.defaultParallelism
    rows = rows.repartition(max(parts, 12))
    lexicon = learn_lexicon(rows.where("words"), settings)
    found = event_table(rows.where("NOT words"), lexicon, "label").collect()
    events = np.array([r["events"] for r in found], float).reshape(-1, FEATURES)
    weights = logistic(events, np.array([r["label"] for r in found], float), settings.ridge)
    return Model(lexicon, weights)


def score_rows(rows: DataFrame, model: Model, *more: str) -> DataFrame:
    """``events`` and ``score`` of the whole ``text`` of every row, and the named columns."""
    found = event_table(rows, model.lexicon, *more)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            events = part.column("events").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
            yield part.append_column("score", pa.array(model.scores(events), pa.float64()))

    return mapped(found, run, f"{fields}, score double")


def score_texts(rows: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Every row with its score put behind; a column of that name is replaced."""
    rows = rows.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.lexicon)
        for part in batches:
            events = np.array([reader.events(t.as_py() or "") for t in part.column(text)]).reshape(-1, FEATURES)
            yield part.append_column(name, pa.array(model.scores(events), pa.float64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return mapped(rows, run, f"{fields}, `{name}` double")


def score_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, settings: Settings = Settings()
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and matched ``clauses`` of every row.

    Null texts count as empty, rows with null ids are scored, repeated rows are
    scored each; nothing but the text enters a score.
    """
    model = fit(docs, labels, settings)
    return score_rows(text_rows(docs, "doc_id", "text"), model, "doc_id").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        F.get("events", F.lit(len(EVENTS) + 1)).cast("long").alias("clauses"),
    )
