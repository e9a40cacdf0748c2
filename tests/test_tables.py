"""Ranking, keyed tables, collisions and quality checks."""

import random
from collections import Counter

import random

import pytest
from pyspark.sql import functions as F

from foliant.operators import collisions, keyed, quality, ranking

C = F.col


def skewed(spark, n=3000):
    """A third of all rows under one key; NULL is a key as well."""
    rng = random.Random(5)
    keys = ["hot", "a", "b", None, "c"]
    rows = [(keys[0] if i % 3 == 0 else rng.choice(keys), rng.randint(0, 400), i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, o int, id int")


def positions(rows, by_key, descending=False):
    groups = {}
    for k, o, i in rows:
        groups.setdefault(k if by_key else 0, []).append((o, i))
    return {
        i: n
        for group in groups.values()
        for n, (_, i) in enumerate(sorted(group, reverse=descending), 1)
    }


@pytest.mark.parametrize("by_key", [True, False])
@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("parts", [1, 16, 300])
def test_positions_match_brute_force(spark, by_key, descending, parts):
    rows, df = skewed(spark)
    placed = ranking.numbered(
        df, ["k"] if by_key else [], ["o", "id"], "n", parts=parts, descending=descending
    )
    assert placed.columns == ["k", "o", "id", "n"]
    assert {r["id"]: r["n"] for r in placed.collect()} == positions(rows, by_key, descending)


def test_ranges_split_the_hot_group(spark):
    """No task holds a group whole, and the broadcast table stays small."""
    _, df = skewed(spark)
    placed = ranking.numbered(df, [], ["o", "id"], "n", parts=16)
    plan = placed._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan.split("== Physical Plan ==")[1].split("BroadcastExchange")[0]


def test_odd_names_nulls_times_and_equal_orders(spark):
    df = spark.range(60).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("order by"),
        F.when(F.col("id") % 5 > 0, F.timestamp_seconds(F.col("id") % 5)).alias("a`b"),
        F.col("id").alias("select"),
    )
    placed = ranking.numbered(df, ["order by"], ["a`b"], "n", parts=8).collect()
    assert len(placed) == 60
    for key in (None, 1, 2):
        group = sorted((r for r in placed if r[0] == key), key=lambda r: r["n"])
        assert [r["n"] for r in group] == list(range(1, 21))
        times = [(r[1] is not None, r[1]) for r in group]
        assert [t[0] for t in times] == sorted(t[0] for t in times)
        assert [t[1] for t in times if t[0]] == sorted(t[1] for t in times if t[0])
    same = spark.range(50).select(F.lit("x").alias("k"), F.lit(1).alias("o"), "id")
    found = ranking.numbered(same, ["k"], ["o"], "n", parts=8)
    assert sorted(r["n"] for r in found.collect()) == list(range(1, 51))
    assert ranking.numbered(same.where("id < 0"), ["k"], ["o"], "n").count() == 0


def test_batches(spark):
    sizes = ranking.batches(spark.range(45), ["id"], 20, parts=4).groupBy("batch").count()
    assert {r[0]: r[1] for r in sizes.collect()} == {0: 20, 1: 20, 2: 5}


def test_collisions(spark):
    rows = [("x", 6, "c"), ("x", 1, "a"), ("x", 0, "d"), ("x", 6, "b"), ("x", 0, "e"), ("y", 4, "f")]
    df = spark.createDataFrame(rows, "slug string, article_order int, file_path string")
    wanted = {"a": "x-001", "b": "x-006", "c": "x-006-2", "d": "x-duplicate", "e": "x-duplicate-2", "f": "y"}
    found = collisions.resolve_slugs(df)
    assert {r["file_path"]: r["slug"] for r in found.collect()} == wanted
    assert collisions.repeated_slugs(found).count() == 0


def test_made_slugs_never_equal_natural_ones(spark):
    rows = [("x", 6, "a"), ("x", 6, "b"), ("x-006-2", 0, "c"), ("x-006-3", 0, "d"), ("z", 1, "e"), ("z", 1, "f"),
            ("z-001", 2, "g"), ("z-001-2", 0, "h"), ("z-001", 2, "i")]
    df = spark.createDataFrame(rows, "slug string, article_order int, file_path string")
    found = {r["file_path"]: r["slug"] for r in collisions.resolve_slugs(df).collect()}
    assert found == {"a": "x-006", "b": "x-006-4", "c": "x-006-2", "d": "x-006-3", "e": "z-001", "f": "z-001-3",
                     "g": "z-001-002", "i": "z-001-002-2", "h": "z-001-2"}


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z")], "k string, o int, v string")
    assert {r["k"]: r["v"] for r in keyed.first_per_key(df, ["k"], ["o"]).collect()} == {"a": "y", "b": "z"}
    again = keyed.first_per_key(keyed.first_per_key(df, ["k"], ["o"]), ["k"], ["o"])
    assert again.count() == 2
    assert {r["k"]: r["v"] for r in keyed.last_per_key(df, ["k"], ["o"]).collect()} == {"a": "x", "b": "z"}


def test_merge_and_insert(spark):
    old = spark.createDataFrame([("a", 9, "old"), ("b", 9, "old")], "k string, o int, v string")
    new = spark.createDataFrame([("b", 1, "new"), ("c", 2, "late"), ("c", 1, "new")], "k string, o int, v string")
    merged = keyed.merge_by_key(old, new, ["k"], ["o"])
    assert {r["k"]: (r["o"], r["v"]) for r in merged.collect()} == {
        "a": (9, "old"), "b": (1, "new"), "c": (2, "late"),
    }
    assert [tuple(r) for r in keyed.insert_missing(old, new, ["k"], ["o"]).collect()] == [("c", 1, "new")]


def test_null_keys_are_equal(spark):
    left = spark.createDataFrame([("a", None), ("b", 1)], "k string, e int")
    right = spark.createDataFrame([("a", None)], "k string, e int")
    assert [r["k"] for r in keyed.absent_rows(left, right, ["k", "e"]).collect()] == ["b"]
    assert keyed.one_sided(left, right, "e").collect()[0]["side"] == "left"


def test_removed_per_group(spark):
    df = spark.createDataFrame([("g", 1, "u"), ("g", 2, "u"), ("h", 1, "u"), ("h", 2, "w"), ("i", 1, "u")],
                               "folder string, position int, key string")
    found = keyed.removed_per_group(df, "folder", ["key"], ["folder", "position"])
    assert {r["folder"]: (r["total"], r["kept"], r["removed"]) for r in found.collect()} == {
        "g": (2, 1, 1), "h": (2, 1, 1), "i": (1, 0, 1),
    }


ARTICLES = "id string, slug string, title string, content string, is_stub boolean, category_id int"
CHUNKS = "article_id string, chunk_index int, embedding array<float>"


def statuses(checks):
    return {r["check_id"]: r["status"] for r in checks.collect()}


def test_article_checks(spark):
    rows = [("1", "a", "T", "", False, 1), ("2", "a", "", None, True, 2), ("3", "b", "T", "x", False, 2)]
    wanted = spark.createDataFrame([(1, 1), (2, 2), (3, 0)], "id int, article_count int")
    found = statuses(quality.check_articles(spark.createDataFrame(rows, ARTICLES), quality.expectations(wanted)))
    assert found == {
        "article_count": "PASS", "empty_full_articles": "FAIL", "empty_stubs": "WARN",
        "missing_titles": "FAIL", "repeated_slugs": "FAIL", "category_count": "FAIL", "stubs": "WARN",
    }


def test_chunk_checks(spark):
    articles = spark.createDataFrame([("1", "a", "T", "x", False, 1), ("2", "b", "T", "y", False, 1)], ARTICLES)
    none = spark.createDataFrame([], CHUNKS)
    assert statuses(quality.check_chunks(articles, none, 2)) == {"chunks_present": "WARN"}
    some = spark.createDataFrame([("1", 0, [1.0, 2.0]), ("1", 1, None), ("1", 2, [1.0])], CHUNKS)
    assert statuses(quality.check_chunks(articles, some, 2)) == {
        "chunks_present": "PASS", "articles_without_chunks": "FAIL", "chunks_without_vector": "WARN",
        "vector_length": "FAIL", "average_chunks": "WARN",
    }


def test_verse_checks_skip_missing_tables(spark):
    bible = spark.createDataFrame([], "id string, chapter int, verse_start int")
    quran = spark.createDataFrame([], "id string, surah int, ayah_start int")
    links = spark.createDataFrame([("v",)], "verse_id string")
    assert statuses(quality.check_verses(bible, quran, links, links)) == {"verses_present": "WARN"}
    quran = spark.createDataFrame([("v", 115, 0), ("w", 2, 1)], "id string, surah int, ayah_start int")
    assert statuses(quality.check_verses(bible, quran, links, links)) == {
        "quran_orphans": "WARN", "surah_range": "FAIL", "ayah_start": "FAIL",
    }


def test_audit(spark):
    local = spark.createDataFrame([("a",), ("b",)], "slug string")
    rows = [("1", "b", "T", " \u00a0", False, 1), ("2", "c", "T", None, True, None)]
    checks = quality.audit_contract(local, spark.createDataFrame(rows, ARTICLES))
    values = {r["check_id"]: (r["status"], r["value"]) for r in checks.collect()}
    assert values["only_local"] == ("FAIL", 1) and values["only_stored"] == ("FAIL", 1)
    assert values["empty_full"] == ("FAIL", 1) and values["empty_stubs"] == ("INFO", 1)
    assert values["stored_categories"] == ("INFO", 1)
    assert {r["status"]: r["checks"] for r in quality.tally(checks).collect()} == {"FAIL": 3, "INFO": 4}


def test_listed_articles(spark):
    missing = spark.createDataFrame([(f"{i:02d}",) for i in range(12)], "id string")
    found = quality.first_missing(missing).collect()
    assert [r["id"] for r in found] == [f"{i:02d}" for i in range(10)] and {r["more"] for r in found} == {2}


def plain_slugs(rows):
    """Unique slugs by trying one number after the other, bases in turn."""
    count = Counter(slug for slug, _, _ in rows)
    natural = {slug for slug in count if count[slug] == 1}
    base = {path: f"{slug}-{order:03d}" if order > 0 else f"{slug}-duplicate" for slug, order, path in rows}
    bases = {base[path] for slug, _, path in rows if count[slug] > 1}
    used, out = set(natural), {}
    for slug, order, path in sorted(rows, key=lambda r: r[2]):
        if count[slug] == 1:
            out[path] = slug
            continue
        n = 1
        while (name := base[path] if n == 1 else f"{base[path]}-{n}") in used or (n > 1 and name in bases):
            n += 1
        used.add(name)
        out[path] = name
    return out


def jobs_of(spark, work):
    spark.sparkContext.setJobGroup("counted", "")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    found = work()
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before


def test_numbers_that_are_taken_are_counted_and_not_tried(spark):
    rng = random.Random(5)

    def rows_of(taken):
        rows = [("a", 2, f"a/{i:04d}") for i in range(400)] + [("a-002-100", 100, f"b/{i}") for i in range(3)]
        rows += [(f"a-002-{n}", 1, f"t/{n}") for n in taken] + [("b", 0, "c/1"), ("b", -1, "c/2"), ("b-duplicate", 5, "c/3")]
        return rows

    counts = []
    for taken in ([2, 3], rng.sample(range(2, 900), 300)):
        rows = rows_of(taken)
        df = spark.createDataFrame(rows, "slug string, article_order int, file_path string")
        found, jobs = jobs_of(spark, lambda df=df: {r.file_path: r.slug for r in collisions.resolve_slugs(df).collect()})
        assert found == plain_slugs(rows) and len(set(found.values())) == len(rows)
        counts.append(jobs)
    assert abs(counts[0] - counts[1]) <= 3


def test_every_category_has_its_expected_articles(spark):
    articles = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "category_id int")
    categories = spark.createDataFrame([(1, 2), (2, 0), (3, 4)], "id int, article_count int")
    found = {tuple(r) for r in quality.category_counts(articles, categories).collect()}
    assert found == {(1, 2, 2, "PASS"), (2, 0, 1, "WARN"), (3, 4, 0, "FAIL"), (9, 0, 1, "FAIL"), (None, 0, 1, "FAIL")}
    assert tuple(quality.expectations(categories).first()) == (6, 3)
    assert tuple(quality.expectations(categories.where("id > 9")).first()) == (0, 0)
