import hashlib
import math

from pyspark.sql import functions as F
from samples import EDGE, documents, words

from foliant.llm import imatch

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
WIDE = imatch.Setup(least=0.0, most=1.0)


def collect(spark, rows, setup=WIDE, wide=4):
    return imatch.fingerprints(documents(spark, rows), setup, rows_per_range=wide).collect()


def test_edited_texts_and_neighbours(spark):
    rows = [(i * 7, words(i, 5 + i)) for i in range(40)] + [(1000, ""), (1001, None), (1002, "ü😀é" * 5)]
    found = {r.doc_id: r for r in collect(spark, rows)}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    for (i, text), (j, after) in zip(order, order[1:] + order[:1]):
        r, half = found[i], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        alike = sum(a == b for a, b in parts(found[i].fingerprint, found[j].fingerprint))
        some = len(list(parts(found[i].fingerprint, found[j].fingerprint)))
        assert math.isclose(r.near_next, alike / some if some else 1.0)


def parts(left, right):
    for at in range(0, len(left), 4):
        a, b = left[at : at + 4], right[at : at + 4]
        if (a, b) != ("____", "____"):
            yield a, b


def test_parts_hash_sorted_distinct_terms_of_the_band(spark):
    setup = imatch.Setup(least=0.3, most=0.7, families=2, levels=3)
    rows = [(1, "a b c"), (2, "C, b! a a"), (3, "d d d"), (4, "a e"), (5, "f")]
    found = {r.doc_id: r for r in collect(spark, rows, setup)}
    # a and, by two documents of five each, b and c are in the band.
    assert found[1].fingerprint == found[2].fingerprint != found[4].fingerprint
    hashes = {t: spark.range(1).select(F.xxhash64(F.lit(t))).first()[0] & (1 << 64) - 1 for t in "abc"}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    terms = sorted(map(signed, hashes.values()))
    wanted = []
    for family in (None, 0, 1):
        for level in range(1 if family is None else 3):
            kept = terms if family is None else [
                t for t in terms if not (t & (1 << 64) - 1) >> (family * 3) & ((2 << level) - 1)
            ]
            wanted.append((family, level, kept))
    got = [found[1].fingerprint[i : i + 4] for i in range(0, len(found[1].fingerprint), 4)]
    by_level = [wanted[0], *sorted(wanted[1:], key=lambda x: (x[1], x[0]))]
    for digits, (_, _, kept) in zip(got, by_level):
        frame = spark.createDataFrame([(kept,)], "t array<long>").select(F.xxhash64("t").bitwiseAND(0xFFFF))
        assert digits == ("%04x" % frame.first()[0] if kept else "____")


def test_edge_rows(spark):
    found = collect(spark, EDGE)
    assert len(found) == len(EDGE)
    texts = {}
    for r, (i, t) in zip(sorted(found, key=lambda r: (repr(r.doc_id), r.n_chars)),
                         sorted(EDGE, key=lambda x: (repr(x[0]), len(x[1] or "")))):
        assert r.doc_id == i and r.n_chars == len(t or "")
        assert texts.setdefault(t or "", r.fingerprint) == r.fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    alone = collect(spark, [(1, "a b")])[0]
    assert alone.near_next == 1.0
    assert collect(spark, []) == []


def test_likeness_tells_edits_from_strangers(spark):
    rows = [(i, words(i, 120, 5000)) for i in range(60)]
    found = collect(spark, rows)
    assert sum(r.near_edited for r in found) > 5 * sum(r.near_next for r in found)


def test_no_python_in_the_plan(spark):
    plan = imatch.fingerprints(documents(spark, EDGE))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
