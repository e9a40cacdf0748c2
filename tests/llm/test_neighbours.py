import numpy as np
from samples import EXTRA

from foliant.llm import neighbours


def table(spark, rows):
    extra = ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame(
        [(i, v, *["x"] * len(EXTRA)) for i, v in rows], f"vec_id long, embedding array<float>, {extra}"
    )


def brute_force(rows, query_ids, nearest):
    usable = [
        (i, np.array(v, float)) for i, v in rows
        if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
    ]
    usable = [(i, np.float32(v).astype(float)) for i, v in usable]
    out = {}
    for q, x in usable:
        if q in query_ids and q not in out:
            near = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in usable if i != q and len(v) == len(x))
            out[q] = near[:nearest]
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 24))
    rows = [(i, (centres[i % 20] + 0.3 * rng.standard_normal(24)).tolist()) for i in range(3000)]
    rows += [(5000 + i, rows[7][1]) for i in range(400)]
    df = table(spark, rows)
    settings = neighbours.Settings(shard=900, queries=16)
    found = neighbours.search(df, df.where("vec_id % 50 = 0"), settings=settings).collect()
    wanted = brute_force(rows, {i for i, _ in rows if i % 50 == 0}, 10)
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    assert got.keys() == wanted.keys()
    hits = 0
    for q, near in wanted.items():
        ranks = sorted(got[q])
        assert [r[0] for r in ranks] == list(range(1, 11))
        assert [r[1:] for r in ranks] == sorted(r[1:] for r in ranks)
        scores = dict((i, s) for s, i in brute_force(rows, {q}, 10**6)[q])
        assert all(abs(scores[i] - s) < 1e-9 for _, s, i in ranks)
        hits += len({i for _, _, i in ranks} & {i for _, i in near})
    assert hits >= 0.95 * 10 * len(wanted)


def test_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [3.0]),
            (9, []), (6, [1.0, 2.0])]
    df = table(spark, rows)
    found = neighbours.search(df, df).collect()
    got = {(r.query_id, r["rank"]): (r.vec_id, round(r.score, 9)) for r in found}
    assert got == {(0, 1): (6, 2.0), (0, 2): (7, 2.0), (6, 1): (7, 0.0), (6, 2): (0, 2.0),
                   (7, 1): (6, 0.0), (7, 2): (0, 2.0)}
    assert neighbours.search(table(spark, []), table(spark, [])).count() == 0


def test_graph_is_flat_and_its_links_are_near():
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((2000, 16)).astype(np.float32)
    settings = neighbours.Settings()
    graph = neighbours.Graph.build(vectors, settings)
    assert [x.dtype for x in graph.layers] == [np.int32] * len(graph.layers) and len(graph.layers) > 1
    for layer in graph.layers:
        assert layer.max() < len(layer) and not (layer == np.arange(len(layer))[:, None]).any()
        for row in layer:
            linked = row[row >= 0]
            assert len(set(linked.tolist())) == linked.size
    queries = rng.standard_normal((50, 16)).astype(np.float32)
    found = graph.search(queries, 96)[:, :10]
    exact = np.argsort(((queries[:, None] - vectors[None]) ** 2).sum(axis=2), axis=1)[:, :10]
    hits = sum(len(set(a.tolist()) & set(b.tolist())) for a, b in zip(found, exact))
    assert hits >= 0.9 * exact.size
