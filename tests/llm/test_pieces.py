import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from samples import EDGE, documents
from sentencepiece import sentencepiece_model_pb2

from foliant.llm import pieces, queries

PATH = queries.piece_bpe()
ALPHABET = [*"aeiou thnsr", "ing", "tion", "é", "日", "\n", "😀", " ", "ß", "\t"]


@pytest.fixture(scope="module")
def library():
    """The public library with the same pieces and scores, told to segment by score."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_ids_equal_the_librarys(library):
    own, rng = pieces.Codec(pieces.Vocabulary.read(PATH)), random.Random(3)
    for _ in range(600):
        text = "".join(rng.choices(ALPHABET, k=rng.randint(0, 25)))
        ids = np.frombuffer(next(own.encode_all(pa.array([text]))), "<i4").tolist()
        assert ids == library.encode(text)
        assert own.decode(ids) == text


def brute_force(text, scores, unknown):
    """Best total over all segmentations."""
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            score = scores.get(text[start:end], unknown if end - start == 1 else None)
            if score is not None:
                best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_segmentation_is_best_and_may_cross_spaces():
    rng = random.Random(5)
    kinds = lambda n: [pieces.UNKNOWN, *[pieces.NORMAL] * n]
    for _ in range(80):
        some = sorted({"".join(rng.choices("ab▁", k=rng.randint(1, 4))) for _ in range(9)})
        scores = [-float(rng.randint(1, 9)) for _ in some]
        own = pieces.Codec(pieces.Vocabulary(["<unk>", *some], [0.0, *scores], kinds(len(some)), False))
        text = "".join(rng.choices("ab c", k=rng.randint(0, 12)))
        ids = own.best(own.prepare(text))
        table = dict(zip(some, scores))
        total = brute_force(own.prepare(text), table, own.unknown_score)
        spent, at, prepared = 0.0, 0, own.prepare(text)
        for i in ids:
            if i:
                # An unknown id stands for a run of unknown characters.
                assert prepared.startswith(some[i - 1], at)
                spent, at = spent + scores[i - 1], at + len(some[i - 1])
            else:
                while at < len(prepared) and not any(prepared.startswith(p, at) for p in some):
                    spent, at = spent + own.unknown_score, at + 1
                break
        if 0 not in ids:
            assert at == len(prepared) and spent == total


def test_round_trip_of_edge_rows(spark):
    encoded = pieces.encode(documents(spark, EDGE), PATH)
    found = pieces.decode(encoded, PATH).collect()
    assert sorted((repr(r.doc_id), r.text) for r in found) == sorted((repr(i), t or "") for i, t in EDGE)
    assert all(r.ids == [] for r in found if not r.text)
    checked = {(r.doc_id, r.n_tokens, r.decoded_sha256) for r in pieces.round_trip(documents(spark, EDGE), PATH).collect()}
    assert checked == {(r.doc_id, len(r.ids), hashlib.sha256(r.text.encode()).hexdigest()) for r in found}
    nulls = spark.createDataFrame([(1, None, "old")], "doc_id long, ids array<int>, text string")
    assert pieces.decode(nulls, PATH).first() == (1, None, None)
    assert pieces.encode(documents(spark, []), PATH).count() == 0
