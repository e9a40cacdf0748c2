import re
import time

import corpus_pipeline as cp
import numpy as np
import pytest
from samples import EDGE, documents, words

from foliant.llm import common, similar


def plain_shingles(text, size=5):
    lowered = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    found = re.findall(rb"[^\x20\x09-\x0D]+", lowered)
    joined = {b" ".join(found[i : i + size]) for i in range(len(found) - size + 1)}
    return joined or ({b" ".join(found)} if found else set())


def plain_roots(rows):
    """Number of the group of every row, by comparing the shingles of all pairs."""
    sets = [plain_shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= 0.8 * len(a | b):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def changed(text, at, new):
    found = text.split(" ")
    for i in at:
        found[i] = f"{new}{i}"
    return " ".join(found)


def all_similarities():
    """Pairs from 0.5 to 1, copies around one text, a paragraph repeated, short texts."""
    rng, rows = np.random.default_rng(4), []
    for i in range(120):
        base = words(1000 + i, 120, 5000)
        rows += [(10 * i, base), (10 * i + 1, changed(base, rng.choice(120, 1 + i % 9, replace=False), f"x{i}y"))]
    hub = words(7, 60, 5000)
    rows += [(5000 + i, changed(hub, [5 + i % 50], f"c{i}y")) for i in range(90)] + [(6000, hub)]
    once = words(8, 100, 5000)
    rows += [(7000, once), (7001, once + (" " + words(9, 12, 5000)) * 8), (7002, once + " " + words(9, 12, 5000))]
    rows += [(8000 + i, words(20, 5 + i, 5000)) for i in range(12)]
    return rows


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_groups_match_the_shingles_of_all_pairs(spark, block_rows, monkeypatch):
    monkeypatch.setattr(similar, "SAMPLED", 2)
    rows = [r for r in EDGE if r[0] is not None] + all_similarities()
    docs = documents(spark, rows).withColumn("mark", cp.F.xxhash64("doc_id", "text"))
    found = similar.near_duplicates(docs, block_rows=block_rows).collect()
    assert len(found) == len(rows)
    by_root, wanted = {}, {}
    for r in found:
        by_root.setdefault(r.root, []).append(r.doc_id)
    for (doc_id, _), root in zip(rows, plain_roots(rows)):
        wanted.setdefault(root, []).append(doc_id)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, wanted.values()))


def test_the_stage_keeps_what_is_less_similar_and_loses_no_copy(spark):
    rows = all_similarities()
    least = {}
    for (doc_id, _), root in zip(rows, plain_roots(rows)):
        least[root] = min(doc_id, least.get(root, doc_id))
    found = cp.near_duplicate_stage(spark, documents(spark, rows), "").collect()
    assert sorted(r.doc_id for r in found) == sorted(least.values())


def test_repeated_rows_are_chosen_before_they_move(spark):
    rows = [(1, "one two three four five six")] * 40 + [(None, "some other words that are alone")] * 40
    docs = documents(spark, rows).withColumn("lang", cp.F.when(cp.F.rand(1) < 0.5, "en"))
    found = cp.near_duplicate_stage(spark, docs, "")
    assert sorted(repr(r.doc_id) for r in found.collect()) == ["1", "None"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan


def test_a_group_of_alike_sets_is_joined_by_a_forest(spark, monkeypatch):
    made, whole = {}, similar.staged

    def counted(df, name):
        table = whole(df, name)
        made.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(similar, "staged", counted)
    hub = words(7, 150, 5000)
    rows = [(i, changed(hub, [i % 150, (i * 7 + 3) % 150], f"c{i}y")) for i in range(400)]
    rows += [(1000 + i, words(50 + i, 40, 5000)) for i in range(20)]
    docs = documents(spark, rows).withColumn("mark", cp.F.xxhash64("doc_id", "text"))
    found = similar.near_duplicates(docs).collect()
    by_root = {}
    for r in found:
        by_root.setdefault(r.root, set()).add(r.doc_id)
    wanted = {}
    for (doc_id, _), root in zip(rows, plain_roots(rows)):
        wanted.setdefault(root, set()).add(doc_id)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, wanted.values()))
    # Far fewer trials than the 79,800 pairs of the group.
    assert sum(made["offers"]) < 8 * 400 and made["offers"][-1] == 0


def test_short_sets_are_never_discarded_by_their_bits(spark):
    rows = [(i, words(i, 8 + i % 20, 5000)) for i in range(60)]
    rows += [(100 + i, rows[i][1] + f" tail{i}") for i in range(60)]
    docs = documents(spark, rows).withColumn("mark", cp.F.xxhash64("doc_id", "text"))
    roots = {r.doc_id: r.root for r in similar.near_duplicates(docs, similar.Setup(differing=0)).collect()}
    plain = dict(zip([i for i, _ in rows], plain_roots(rows)))
    assert all((roots[i] == roots[100 + i]) == (plain[i] == plain[100 + i]) for i in range(60))
    assert any(plain[i] == plain[100 + i] for i in range(60))


def test_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(2)
    for size in (0, 1, 30, 400, 3000):
        base = rng.integers(0, 1 << 63, size, np.uint64)
        for changed_ in (0, 1, size // 5, size):
            other = np.concatenate([base[changed_:], rng.integers(0, 1 << 63, changed_ // 2, np.uint64)])
            x, y = (np.array(similar._sketch(v)).view(np.uint64) for v in (base, other))
            differing = int(np.bitwise_count(x ^ y).sum())
            assert differing <= np.setxor1d(base, other).size and (differing > 0 or size < 30 or not changed_)


def test_candidates_that_cannot_be_similar_are_not_tried(spark, monkeypatch):
    """Near copies of one text that are alike to a few others only: what is refuted does not grow with their pairs."""
    made, whole = {}, similar.staged

    def counted(df, name):
        table = whole(df, name)
        made.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(similar, "staged", counted)
    hub, rng = words(7, 150, 5000), np.random.default_rng(5)
    rows = [(i, changed(hub, rng.choice(150, 7, replace=False), f"c{i}y")) for i in range(300)]
    rows += [(1000 + i, changed(rows[i][1], [3, 77], f"d{i}y")) for i in range(60)]
    docs = documents(spark, rows).withColumn("mark", cp.F.xxhash64("doc_id", "text"))
    by_root, wanted = {}, {}
    for r in similar.near_duplicates(docs).collect():
        by_root.setdefault(r.root, set()).add(r.doc_id)
    for (doc_id, _), root in zip(rows, plain_roots(rows)):
        wanted.setdefault(root, set()).add(doc_id)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, wanted.values()))
    assert sum(made["offers"]) < 6 * len(rows)


def test_links_of_the_ring_are_tried(spark, monkeypatch):
    """Chains around the ring find close copies; with fewer of them no group changes."""
    made, whole = {}, similar.staged

    def counted(df, name):
        table = whole(df, name)
        made.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(similar, "staged", counted)
    long = words(3, 900, 50_000)
    rows = [(i, changed(long, [5 + 7 * i], "x")) for i in range(60)]
    docs = documents(spark, rows).withColumn("mark", cp.F.xxhash64("doc_id", "text"))
    assert len({r.root for r in similar.near_duplicates(docs).collect()}) == 1
    assert made["ring-links"][0] >= 1
    assert len({r.root for r in similar.near_duplicates(docs, similar.Setup(near=1)).collect()}) == 1


def test_groups_begin_with_the_ring(spark, monkeypatch):
    """What the ring links makes no offers any more, and links it finds are still confirmed."""
    made, whole = {}, similar.staged

    def counted(df, name):
        table = whole(df, name)
        made.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(similar, "staged", counted)
    long = words(3, 3000, 50_000)
    rows = [(i, changed(long, [5 + 7 * i], "x")) for i in range(40)]
    docs = documents(spark, rows).withColumn("mark", cp.F.xxhash64("doc_id", "text"))
    assert len({r.root for r in similar.near_duplicates(docs).collect()}) == 1
    assert made["ring-links"][0] >= 39 and made["offers"] == [0]
    made.clear()
    apart = [(i, words(90 + i, 300, 5000)) for i in range(30)]
    docs = documents(spark, apart).withColumn("mark", cp.F.xxhash64("doc_id", "text"))
    assert len({r.root for r in similar.near_duplicates(docs, similar.Setup(near=31)).collect()}) == 30
    assert made["ring-links"][0] > 0


def test_rounds_hang_groups_together_without_stars(spark, monkeypatch):
    """Stars run over the ring's links and over all links at the end, never inside a round."""
    made, stars, whole, components = {}, [], similar.staged, similar.components

    def counted(df, name):
        table = whole(df, name)
        made.setdefault(name, []).append(table.count())
        return table

    def noted(links, name):
        stars.append(name)
        return components(links, name)

    monkeypatch.setattr(similar, "staged", counted)
    monkeypatch.setattr(similar, "components", noted)
    # Each text is similar to the next three only.
    hub = words(7, 90, 5000)
    rows = [(i, changed(hub, [i, i + 1], f"c{i}y")) for i in range(80)]
    docs = documents(spark, rows).withColumn("mark", cp.F.xxhash64("doc_id", "text"))
    found = {}
    for r in similar.near_duplicates(docs).collect():
        found.setdefault(r.root, set()).add(r.doc_id)
    wanted = {}
    for (doc_id, _), root in zip(rows, plain_roots(rows)):
        wanted.setdefault(root, set()).add(doc_id)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, wanted.values()))
    assert len(made["offers"]) > 2 and len(found) == 1 and stars == ["ring-groups", "similar-groups"]


def test_staged_tables_leave_no_shuffle_files(spark):
    def files():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return set(re.findall(r"/(shuffle_\w+)", disk.getAllFiles().mkString(" ")))

    before, setting = files(), spark.conf.get(common._RELEASE, None)
    table = common.staged(spark.range(1000).groupBy((cp.F.col("id") % 7).alias("k")).count(), "counts")
    until = time.monotonic() + 5
    while files() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(common._RELEASE, None) == setting
    assert {r["k"]: r["count"] for r in table.collect()} == {k: 143 if k < 6 else 142 for k in range(7)}
