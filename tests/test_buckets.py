"""Bucketed tables: what a write leaves alone, what it replaces, and what it would do."""

import pytest
from pyspark.sql import functions as F

from foliant.operators import changes
from foliant.sinks.buckets import BucketTable

FIELDS = "k long, v string, n int"


@pytest.fixture
def held(spark, tmp_path):
    table = BucketTable(spark, f"file://{tmp_path}/table", spark.createDataFrame([], FIELDS).schema, ["k"], 8)
    table.merge(spark.createDataFrame([(i, f"v{i}", 0) for i in range(100)] + [(None, "none", 0)], FIELDS), ["n"])
    return table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def places(table):
    return {e["bucket"]: e["path"] for e in table.entries()}


def test_a_merge_of_one_key_leaves_the_other_buckets(held, spark):
    before, old = places(held), rows(held.read())
    held.merge(spark.createDataFrame([(7, "older", 1), (7, "newer", 2)], FIELDS), ["n"])
    after = places(held)
    assert sum(before[b] != after[b] for b in before) == 1 and before.keys() == after.keys()
    assert rows(held.read()) == sorted([r for r in old if r[0] != 7] + [(7, "newer", 2)], key=repr)
    held.merge(spark.createDataFrame([(None, "other", 1)], FIELDS), ["n"])
    assert [r for r in rows(held.read()) if r[0] is None] == [(None, "other", 1)]


def test_missing_rows_are_added_once(held, spark):
    more = spark.createDataFrame([(5, "x", 1), (200, "b", 2), (200, "a", 1)], FIELDS)
    held.insert_missing(more, ["n"])
    once, entries = rows(held.read()), places(held)
    assert (200, "a", 1) in once and (5, "v5", 0) in once and len(once) == 102
    held.insert_missing(more, ["n"])
    assert places(held) == entries


def test_a_parent_without_new_children_loses_the_old_ones(held, spark):
    held.replace_groups(
        spark.createDataFrame([(1, "one", 1), (1, "two", 2)], FIELDS), spark.createDataFrame([(1,), (2,), (None,)], "k long")
    )
    found = rows(held.read())
    assert [r for r in found if r[0] in (1, 2, None)] == [(1, "one", 1), (1, "two", 2)] and len(found) == 100


def test_a_run_that_fails_leaves_the_table(held, spark):
    old = rows(held.read())
    broken = spark.createDataFrame([(1, "x", 1)], FIELDS).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        held.replace(broken)
    assert rows(held.read()) == old
    held.replace(spark.createDataFrame([], FIELDS))
    assert rows(held.read()) == [] and held.entries()[0]["version"] == 2
    held.merge(spark.createDataFrame([(1, "again", 1)], FIELDS), ["n"])
    assert rows(held.read()) == [(1, "again", 1)]


def test_a_dry_run_says_what_the_run_does(held, spark):
    new = spark.createDataFrame([(3, "v3", 0), (4, "x", 0), (5, None, 0), (300, "y", 1), (None, "none", 0)], FIELDS)
    before, entries = {r[0]: r for r in rows(held.read())}, places(held)
    said = {r.k: r.change for r in held.dry_run(new, ["n"]).collect()}
    assert places(held) == entries
    held.merge(new, ["n"])
    after = {r[0]: r for r in rows(held.read())}
    done = {k: "new" if k not in before else "equal" if before[k] == after[k] else "changed" for k in (3, 4, 5, 300, None)}
    assert said == done == {3: "equal", 4: "changed", 5: "changed", 300: "new", None: "equal"}
    counted = changes.counts(held.dry_run(new, ["n"], whole=True)).first()
    assert tuple(counted) == (0, 0, 5, 97)


def test_classes_of_maps_nulls_and_no_columns(spark):
    fields = "k int, a string, b string, m map<string,int>"
    old = spark.createDataFrame([(1, "x", None, {"p": 1}), (2, None, "x", None)], fields)
    new = spark.createDataFrame([(1, None, "x", {"p": 1}), (2, None, "x", {"p": 1})], fields)
    assert {r.k: r.change for r in changes.classify(old, new, ["k"]).collect()} == {1: "changed", 2: "changed"}
    assert {r.k: r.change for r in changes.classify(old, old, ["k"]).collect()} == {1: "equal", 2: "equal"}
    bare = old.select("k")
    assert {r.change for r in changes.classify(bare, bare.where("k = 1"), ["k"]).collect()} == {"equal", "gone"}


def test_the_first_check_that_refuses_is_named(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "a"), (None, "a"), ("x", "")], "n string, t string")
    checks = {
        "number": {"no number": F.col("n").try_cast("int").isNull() & F.col("n").isNotNull()},
        "text": {"empty": F.col("t") == "", "never": F.lit(None).cast("boolean")},
    }
    found = [(r.step, r.reason) for r in changes.refused(df, checks).collect()]
    assert found == [(None, None), ("number", "no number"), (None, None), ("number", "no number")]


