import numpy as np
import pytest
from samples import EDGE, documents

from foliant.llm import queries
from foliant.llm import toxicity as tx

DATA = "/root/testdata/sf0.1"
PLAIN, AIMED, NEGATED, REPORTED, THREAT, LOOSE = range(6)


@pytest.mark.parametrize(
    "text, event",
    [
        ("the grumblor sat there", PLAIN),
        ("you are a grumblor", AIMED),
        ("a grumblor, that is what you are", AIMED),
        ("the report is not grumblor", NEGATED),
        ("this is not at all a very long way to the grumblor", AIMED),
        ("somebody said the grumblor sat", REPORTED),
        ("a \"grumblor\" sat", REPORTED),
        ("we will hurt you", LOOSE),
        ("you we will hurt", THREAT),
        ("never hurt anybody", NEGATED),
        ("grumbloric ways", PLAIN),
    ],
)
def test_clauses_are_judged_by_their_pattern(text, event):
    found = tx.Reader({"grumblor": 2.0}).events(text)
    assert [e for e in range(6) if found[e]] == [event]


def test_clauses_do_not_reach_into_each_other():
    reader = tx.Reader({"grumblor$": 1.0})
    assert reader.events("You. A grumblor sat! Said who? Not.")[PLAIN] == 1.0
    assert reader.events("Nothing here\nat all") == [0.0] * tx.FEATURES
    assert reader.events("") == [0.0] * tx.FEATURES


def test_composition_does_what_one_after_another_does():
    rng = np.random.default_rng(1)
    first, second = tx.negation(), tx.reported_speech()
    both = first.then(second, range(tx.END))
    for _ in range(100):
        state, a, b, single, double = both.start, first.start, second.start, [], []
        for symbol in rng.integers(0, tx.END, 12).tolist():
            state, out = both.arcs[state, symbol]
            double += out
            a, written = first.arcs[a, symbol]
            for s in written:
                b, more = second.arcs[b, s]
                single += more
        assert single == double


def test_held_out_accuracy(spark):
    found = queries.op9_toxicity(spark, DATA).collect()
    labels = {r.doc_id: r.toxic for r in queries.table(spark, DATA, "labels").collect()}
    kept = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    toxic = [p for p, t in kept if t]
    assert len(found) == 10_000 and all(0 <= r.score <= 1 for r in found)
    assert np.mean(toxic) > 0.8 and np.mean([p for p, t in kept if not t]) < 0.01


def test_edge_rows_and_missing_labels(spark):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert tx.score_documents(documents(spark, EDGE), none).count() == len(EDGE)
    rows = [(i, "you grumblor" if i % 2 else "fine day") for i in range(60)] + EDGE
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    settings = tx.Settings(contexts=1, least=2)
    found = tx.score_documents(documents(spark, rows), labels, settings=settings).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == r.doc_id % 2 for r in found if r.doc_id is not None and r.doc_id > 8)
    assert tx.score_documents(documents(spark, []), labels).count() == 0
    model = tx.fit(documents(spark, rows), labels, settings)
    kept = tx.score_texts(documents(spark, rows), model).collect()
    assert len(kept) == len(rows) and {r.root for r in kept} == {"x"}
