"""SentencePiece encoding and decoding with a vocabulary's own scores.

An Aho-Corasick automaton over the pieces reads a text once.  At every character
its output links give all pieces that end there, and each may improve the best
segmentation that ends there: Viterbi in a single pass.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import batch, mapped, per_process, text_rows
from .words import WordTable, in_portions

# Fixed values of the model format: kinds of pieces, the mark of a space, the
# penalty of an unknown character below the worst piece.
NORMAL, UNKNOWN, CONTROL, OWN, UNUSED, BYTE = range(1, 7)
SPACE = "▁"
UNKNOWN_PENALTY = 10.0

# Words whose ids a worker remembers, characters of text that are looked up at a
# time, and characters of words that are segmented in one go.
REMEMBERED = 500_000
AT_ONCE = 1 << 21
LAID = 4000

# Rows a task holds at a time.
ROWS_AT_ONCE = 1000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores and kinds, and how texts are prepared."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool = True
    squeeze: bool = False

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a model file.  Models that rewrite characters first are refused."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model rewrites characters or puts spaces behind words")
        return cls(
            [p.piece for p in model.pieces], [p.score for p in model.pieces], [p.type for p in model.pieces],
            rules.add_dummy_prefix, rules.remove_extra_whitespaces,
        )


class Codec:
    """Encodes and decodes single texts."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        normal = [s for s, k in zip(vocabulary.scores, vocabulary.kinds) if k == NORMAL]
        worst, best = min(normal, default=0.0), max(normal, default=0.0)
        self.unknown_score = worst - UNKNOWN_PENALTY
        self.unknown = vocabulary.kinds.index(UNKNOWN) if UNKNOWN in vocabulary.kinds else 0
        usable = []
        for i, (piece, score, kind) in enumerate(zip(vocabulary.pieces, vocabulary.scores, vocabulary.kinds)):
            if kind in (NORMAL, OWN) and piece:
                usable.append(piece)
                own = len(piece) * best - 0.1 if kind == OWN else score
                self.automaton.add_word(piece, (len(piece), own, i))
        if usable:
            self.automaton.make_automaton()
        else:
            self.automaton = None
        self.bytes_ = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.bytes_.items()}
        # Where no piece has a space mark behind another character, the best
        # segmentation of a text is that of its words, one after another.
        self.by_words = not any(SPACE in p.lstrip(SPACE) for p in usable)
        self.singles = {p for p in usable if len(p) == 1}
        self.table = WordTable(self.learn, REMEMBERED)
        shown = {CONTROL: "", UNKNOWN: " ⁇ "}
        self.shown = [
            bytes([self.byte_of[i]]) if k == BYTE else shown.get(k, p.replace(SPACE, " ")).encode()
            for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds))
        ]

    def prepare(self, text: str) -> str:
        if self.v.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if self.v.dummy_prefix and text:
            text = " " + text
        return text.replace(" ", SPACE)

    def best(self, text: str) -> list[int]:
        """Ids of the best segmentation of a prepared text."""
        n = len(text)
        score, back = [0.0] + [-np.inf] * n, [(0, 0)] * (n + 1)
        done, single = 0, False

        def close(until: int) -> None:
            # Ends without a piece of one character may be an unknown one.
            nonlocal done, single
            while done < until:
                done += 1
                if not single:
                    other = score[done - 1] + self.unknown_score
                    if other > score[done]:
                        score[done], back[done] = other, (1, -1)
                single = False

        for end, (size, own, i) in self.automaton.iter(text) if self.automaton else ():
            end += 1
            if end > done + 1:
                close(end - 1)
            total = score[end - size] + own
            if total > score[end]:
                score[end], back[end] = total, (size, i)
            single = single or size == 1
        close(n)
        ids, at, unknown = [], n, False
        while at:
            size, i = back[at]
            if i >= 0:
                ids.append(i)
            elif self.bytes_:
                ids += [self.bytes_[b] for b in reversed(text[at - 1].encode())]
            elif not unknown:
                ids.append(self.unknown)
            unknown = i < 0
            at -= size
        return ids[::-1]

    def learn(self, fresh: list[str]) -> dict[str, bytes]:
        """Ids of words, each with a space mark before it.

        Words of characters that are all pieces are laid end to end and read in
        one pass; no piece goes from one into the next.
        """
        learned, block, length = {}, [], 0
        for word in fresh:
            if self.automaton is None or SPACE not in self.singles or not self.singles.issuperset(word):
                learned[word] = np.array(self.best(SPACE + word), "<i4").tobytes()
                continue
            block.append(word)
            length += len(word) + 1
            if length >= LAID:
                learned.update(zip(block, self._laid(block)))
                block, length = [], 0
        learned.update(zip(block, self._laid(block)))
        return learned

    def _laid(self, words: list[str]) -> list[bytes]:
        text = "".join([SPACE + w for w in words])
        score, back = [0.0] + [-np.inf] * len(text), [None] * (len(text) + 1)
        at = 0
        for at, piece in self.automaton.iter(text):
            at += 1
            total = score[at - piece[0]] + piece[1]
            if total > score[at]:
                score[at], back[at] = total, piece
        at, ids, counts = len(text), [], []
        for word in reversed(words):
            start, before = at - len(word) - 1, len(ids)
            while at > start:
                size, _, i = back[at]
                ids.append(i)
                at -= size
            counts.append(len(ids) - before)
        data = np.array(ids[::-1], "<i4").tobytes()
        ends = (np.cumsum(counts[::-1]) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids as bytes of signed 32-bit integers.

        Words met before are looked up; texts with runs of spaces, or under a
        vocabulary that joins words, are segmented whole.
        """
        simple = self.by_words and bool(self.bytes_) and self.v.dummy_prefix and not self.v.squeeze
        for part in in_portions(texts, AT_ONCE):
            odd = pc.match_substring_regex(part, f"^$|^ |  |{SPACE}" if simple else "")
            found = self.table.ids(part.filter(pc.invert(odd)), " ")
            for text, whole in zip(part, odd.to_pylist()):
                yield np.array(self.best(self.prepare(text.as_py())), "<i4").tobytes() if whole else next(found)

    def lists(self, texts: pa.Array) -> pa.ListArray:
        found = list(self.encode_all(texts))
        ends = np.cumsum([0, *(len(x) // 4 for x in found)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no text become replacement characters."""
        return self._text(b"".join(map(self.shown.__getitem__, ids)))

    def _text(self, data: bytes) -> str:
        text = data.decode("utf-8", "replace")
        return text[1:] if self.v.dummy_prefix and text.startswith(" ") else text

    def decode_all(self, lists: pa.Array) -> Iterator[str | None]:
        """Texts of lists of ids; what the ids stand for is put in their places at once."""
        placed = pa.array(self.shown, pa.binary()).take(lists.flatten())
        data = memoryview(placed.buffers()[2] or b"") if len(placed) else memoryview(b"")
        ends = np.frombuffer(placed.buffers()[1], np.int32) if len(placed) else np.zeros(1, np.int32)
        high = 0
        for size in pc.list_value_length(lists).to_pylist():
            if size is None:
                yield None
                continue
            low, high = high, high + size
            yield self._text(bytes(data[ends[low] : ends[high]]))


def codec(path: str) -> Codec:
    return per_process(f"pieces {path}", lambda: Codec(Vocabulary.read(path)))


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of every row's whole text.

    Null and empty texts have no ids, null ids of rows are kept, repeated rows are
    encoded each, other columns are left out.  ``model`` is the path of a model
    file that every executor has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for rows in batches:
            for low in range(0, rows.num_rows, ROWS_AT_ONCE):
                part = rows.slice(low, ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), own.lists(part.column("text"))], ["doc_id", "ids"]
                )

    return mapped(text_rows(docs, key, text), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """Every row with the text of its ids put behind, replacing a column of that name; null ids give a null."""
    rows = encoded.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for part in batches:
            for low in range(0, part.num_rows, ROWS_AT_ONCE):
                some = part.slice(low, ROWS_AT_ONCE)
                texts = pa.array(own.decode_all(some.column(ids)), pa.string())
                yield some.append_column(name, texts)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return mapped(rows, run, f"{fields}, `{name}` string")


def round_trip(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and the SHA-256 of the text the ids decode to, in one pass."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.list_(pa.int32())), ("decoded_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for rows in batches:
            for low in range(0, rows.num_rows, ROWS_AT_ONCE):
                part = rows.slice(low, ROWS_AT_ONCE)
                ids = own.lists(part.column("text"))
                marks = [hashlib.sha256(t.encode()).hexdigest() for t in own.decode_all(ids)]
                counts = pc.list_value_length(ids)
                yield batch(schema, part.column("doc_id"), counts, ids, marks)

    return mapped(
        text_rows(docs, key, text), run, "doc_id long, n_tokens int, ids array<int>, decoded_sha256 string"
    )
