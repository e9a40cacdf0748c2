import random

import numpy as np
import pytest
from samples import EXTRA

from foliant.llm import hard_negatives as hn

SETTINGS = [hn.Settings(), hn.Settings(shard=7, anchors=2, step=1, positives=3, negatives=4)]


def table(spark, rows):
    extra = ", ".join(f"{c} string" for c in EXTRA if c != "label")
    full = [(i, v, y, *["x"] * (len(EXTRA) - 1)) for i, v, y in rows]
    return spark.createDataFrame(full, f"vec_id long, embedding array<double>, label int, {extra}")


def brute_force(rows, every, s):
    usable = sorted({
        (i, y, tuple(int(np.floor(s.scale * x)) for x in v)) for i, v, y in rows
        if None not in (i, v, y) and None not in v and all(map(np.isfinite, v))
    })
    out, done = [], set()
    for a, y, v in usable:
        if a % every or a in done:
            continue
        done.add(a)
        other = [(-sum(p * q for p, q in zip(v, w)), i, z) for i, z, w in usable if i != a and len(w) == len(v)]
        near = sorted((n, i) for n, i, z in other if z == y)[: s.positives]
        for p, positive in near:
            fits = sorted((n, i) for n, i, z in other if z != y and s.low * -p <= 100 * -n <= s.high * -p)
            out += [(a, positive, k, i, -p, -n) for k, (n, i) in enumerate(fits[: s.negatives], 1)]
    return sorted(out)


def listed(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[c] for c in names) for r in df.collect())


@pytest.mark.parametrize("settings", SETTINGS, ids=["as dealt", "small shards"])
def test_matches_brute_force(spark, settings):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((5, 12))
    rows = [(i, (centres[i % 5] + 0.8 * rng.standard_normal(12)).tolist(), int(rng.integers(0, 4))) for i in range(400)]
    # A third of all rows alike: ties by the smaller id, over several shards.
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(200)]
    found = listed(hn.mine(table(spark, rows), "vec_id % 40 = 0", settings))
    assert found == brute_force(rows, 40, settings) and len(found) > 100


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.5, 0.5], 2), (3, [0.6, 0.1], 2), (4, [0.5, nan], 2), (5, [inf, 0.0], 2),
            (6, [0.5, None], 2), (7, None, 2), (8, [0.5, 0.4], None), (None, [0.5, 0.4], 2), (9, [0.4], 2), (10, [], 1), (11, [], 2),
            (3, [0.6, 0.1], 2), (12, [0.0, 0.0], 1), (13, [-1.0, -1.0], 1), (0, [1.0, 0.5], 1), (14, [0.5, 0.4], 0), (14, [0.4, 0.5], 3)]
    for settings in SETTINGS:
        found = listed(hn.mine(table(spark, rows), "vec_id >= 0", settings))
        assert found == brute_force(rows, 1, settings) and found
    assert hn.mine(table(spark, []), "vec_id = 0").count() == 0


def test_components_beyond_doubles_and_longs(spark):
    rows = [(i, [x, 1.0], y) for i, x, y in [(0, 1e6, 1), (1, 2e6, 1), (2, 1.5e6, 2), (3, 1.1e6, 2), (4, 0.7e6, 2)]]
    assert listed(hn.mine(table(spark, rows), "vec_id = 0")) == brute_force(rows, 100, hn.Settings())
    # Scores no long can hold are held at 2^62: all are alike, and no window reaches below.
    rows = [(i, [x], y) for i, x, y in [(0, 1e30, 1), (1, 2e30, 1), (2, 1.5e30, 2), (3, -1e30, 2)]]
    assert listed(hn.mine(table(spark, rows), "vec_id = 0")) == []


def test_search_stops_early_and_is_exact():
    rng = random.Random(3)
    own = np.random.default_rng(4)
    for _ in range(60):
        n, width = rng.randint(1, 200), rng.randint(0, 4)
        vectors = own.integers(-20, 21, (n, width)) * (own.random((n, width)) < 0.7).astype(int)
        ids = own.permutation(n)
        lists = hn.Lists(ids, vectors, hn.Lists.sorted_places(vectors))
        anchor = own.integers(-20, 21, width)
        windows = [(rng.randint(-50, 100), rng.randint(0, 300)) for _ in range(3)]
        exact = sorted((-int(v @ anchor), int(i)) for v, i in zip(vectors, ids) if i != 0)
        wanted = [(k, i, -s) for k, (a, b) in enumerate(windows) for s, i in [x for x in exact if a <= -x[0] <= b][:5]]
        assert lists.search(anchor, 0, windows, 5, rng.choice([1, 8])) == wanted
    # In few dimensions the search ends long before the lists do.
    vectors = own.integers(-1000, 1000, (20_000, 2))
    lists = hn.Lists(np.arange(20_000), vectors, hn.Lists.sorted_places(vectors))
    seen, plain = [], lists.scores
    lists.scores = lambda places, anchor: seen.append(len(places)) or plain(places, anchor)
    lists.search(np.array([500, 400]), -1, [(-hn.MOST, hn.MOST)], 5, 32)
    assert sum(seen) < 4000
