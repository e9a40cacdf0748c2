import itertools
import random

import numpy as np
from samples import EDGE, documents

from foliant.llm import quality, queries

DATA = "/root/testdata/sf0.01"


def test_rising_sequence_is_nearest():
    rng = random.Random(1)
    grid = [i / 4 for i in range(5)]
    for _ in range(40):
        n = rng.randint(1, 5)
        values = np.array([rng.choice([0.0, 0.25, 0.5, 1.0]) for _ in range(n)])
        weights = np.array([float(rng.randint(1, 3)) for _ in range(n)])
        found = quality.pool_adjacent(values, weights)
        loss = lambda x: float((weights * (values - np.array(x)) ** 2).sum())
        assert (np.diff(found) >= 0).all()
        assert loss(found) <= min(loss(c) for c in itertools.combinations_with_replacement(grid, n)) + 1e-12


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(3)
    width = len(quality.STATISTICS)
    settings = quality.Settings(features=4000)
    directions = rng.standard_normal((width, settings.features)) / (settings.width * np.sqrt(width))
    model = quality.Model(np.zeros(width), np.ones(width), directions, rng.uniform(0, 2 * np.pi, 4000),
                          np.zeros(1), np.zeros(0), np.zeros(0))
    x = rng.standard_normal((20, width))
    waves = model.features(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    wanted = np.exp(-distance / (2 * settings.width**2 * width))
    assert np.abs(waves @ waves.T - wanted).max() < 0.12


def test_sums_of_parts_equal_one_solution(spark):
    docs, labels = (queries.table(spark, DATA, t) for t in ("documents", "labels"))
    rows = quality.statistics(docs).join(quality.one_label(labels, "quality"), "doc_id").collect()
    described = quality.statistics(docs)
    small = quality.Settings(features=16, ridge=1e-3)
    model = quality.fit(described, quality.one_label(labels, "quality"), quality._calibrates(), small)
    stats = np.array([r.stats for r in rows])
    calibrates = np.array([r.doc_id in _calibrating(spark, docs) for r in rows])
    x, y = model.features(stats)[~calibrates], np.array([r.label for r in rows], float)[~calibrates]
    penalty = np.full(x.shape[1], small.ridge * len(y))
    penalty[-1] = 0
    wanted = np.linalg.solve(x.T @ x + np.diag(penalty + 1e-9), x.T @ y)
    assert np.allclose(x @ model.weights, x @ wanted, atol=1e-6)


_SEEN = {}


def _calibrating(spark, docs):
    if "ids" not in _SEEN:
        _SEEN["ids"] = {r.doc_id for r in docs.where(quality._calibrates()).select("doc_id").collect()}
    return _SEEN["ids"]


def test_held_out_accuracy(spark):
    found = queries.op4_quality(spark, DATA).collect()
    labels = {r.doc_id: r.quality for r in queries.table(spark, DATA, "labels").collect()}
    kept = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert len(found) == 1000 and all(0 <= r.score <= 1 for r in found)
    assert np.mean([a == b for a, b in kept]) > 0.93


def test_edge_rows_and_missing_labels(spark):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    found = quality.score_documents(documents(spark, EDGE), none).collect()
    assert len(found) == len(EDGE) and all(abs(r.score - 0.5) < 0.01 for r in found)
    some = spark.createDataFrame([(i, int(i > 4)) for i in range(1, 9)], "doc_id long, quality int")
    found = quality.score_documents(documents(spark, EDGE), some).collect()
    assert len(found) == len(EDGE) and all(0 <= r.score <= 1 for r in found)
    assert quality.score_documents(documents(spark, []), some).count() == 0
    model = quality.learn(documents(spark, EDGE), some)
    kept = quality.score_texts(documents(spark, EDGE), model).collect()
    assert len(kept) == len(EDGE) and {r.root for r in kept} == {"x"}
