import corpus_pipeline as cp
import pytest
from samples import EDGE, documents, words
from test_repeats import plain_ranges
from test_simhash import near_copies
from test_similar import plain_roots

from foliant.llm import packing, queries, tokens

DATA = "/root/testdata/sf0.01"


def test_stages_are_the_five_in_order():
    assert [name for name, _ in cp.STAGES] == ["quality", "toxicity", "near_duplicates", "repeats", "packing"]


def test_near_duplicates_keep_one_row_of_each_group(spark):
    rows = [r for r in EDGE if r[0] is not None] + near_copies()
    least = {}
    for (doc_id, _), root in zip(rows, plain_roots(rows)):
        least[root] = min(doc_id, least.get(root, doc_id))
    found = cp.near_duplicate_stage(spark, documents(spark, rows), "")
    assert found.columns == cp.COLUMNS
    assert sorted(r.doc_id for r in found.collect()) == sorted(least.values())
    # A null id stays only where no other row of the group has an id.
    nulls = documents(spark, [(None, "one two three four five six"), (9, "one two three four five six"),
                              (None, "alone in here"), (None, "alone in here")])
    kept = cp.near_duplicate_stage(spark, nulls, "").collect()
    assert sorted((repr(r.doc_id), r.text) for r in kept) == [
        ("9", "one two three four five six"), ("None", "alone in here"),
    ]


def test_repeated_passages_are_cut(spark):
    passage = words(1, 80) + " ü"
    rows = [(i, words(50 + i, 40) + " é" + passage + words(90 + i, 30)) for i in range(12)]
    rows += [(20, passage), (21, None), (22, ""), (23, words(7, 20))]
    found = {r.doc_id: r for r in cp.repeats_stage(spark, documents(spark, rows), "").collect()}
    texts = [(t or "").encode() for _, t in rows]
    for (i, text), data, ranges in zip(rows, texts, plain_ranges(texts, cp.REPEAT)):
        left, at = b"", 0
        for low, high in ranges:
            while low and data[low] & 0xC0 == 0x80:
                low -= 1
            while high < len(data) and data[high] & 0xC0 == 0x80:
                high += 1
            left, at = left + data[at:low], high
        left += data[at:]
        if ranges and not left.strip():
            assert i not in found
        else:
            assert found[i].text == (left.decode() if ranges else text)
            assert found[i].n_chars == (len(left.decode()) if ranges else None)
    assert any(plain_ranges(texts, cp.REPEAT)) and 20 not in found


@pytest.mark.parametrize("rows", [[], EDGE], ids=["no rows", "edge rows"])
def test_every_stage_takes_any_rows(spark, rows):
    for name, stage in cp.STAGES:
        found = stage(spark, documents(spark, rows), DATA)
        if name != "packing":
            assert found.columns == cp.COLUMNS and found.count() <= len(rows)
            continue
        encode = tokens.encoder(queries.byte_bpe())
        wanted = sorted(len(encode.whole([t or ""])[0]) // 4 + 1 for _, t in rows)
        inside = {}
        for r in found.collect():
            assert r.start == r.piece * packing.Plan().max_length and r.length <= r.padded
            inside.setdefault((r.doc_id, r.piece), []).append(r.length)
        assert sum(map(sum, inside.values())) == sum(wanted)
        assert sum(len(n) for (_, piece), n in inside.items() if piece == 0) == len(rows)


def test_filters_follow_their_scores_and_keep_clean_documents(spark):
    docs = queries.table(spark, DATA, "documents")
    labels = {r.doc_id: r for r in queries.table(spark, DATA, "labels").collect()}
    scored = {r.doc_id: r.predicted for r in queries.op9_toxicity(spark, DATA).collect()}
    kept = {r.doc_id for r in cp.toxicity_stage(spark, docs, DATA).select("doc_id").collect()}
    assert kept == {i for i, p in scored.items() if not p}
    good = {r.doc_id for r in cp.quality_stage(spark, docs, DATA).select("doc_id").collect()}
    clean = [i for i, r in labels.items() if r.quality == 1]
    poor = [i for i, r in labels.items() if r.quality == 0]
    assert sum(i in good for i in clean) > 0.98 * len(clean)
    assert sum(i in good for i in poor) < 0.15 * len(poor)


def test_whole_run(spark):
    found = cp.run(spark, "/root/testdata/sf0.001").collect()
    assert 0 < len({r.doc_id for r in found}) < 200
    assert all(r.length <= r.padded for r in found)
