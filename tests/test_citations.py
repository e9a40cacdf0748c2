import re

import pytest
from pyspark.sql import functions as F

from foliant.functions import citations as cite
from foliant.operators import citation_index as index


def references(spark, text):
    df = spark.createDataFrame([(1, text)], "id int, content string")
    rows = index.with_reference(index.extract_citations(df)).collect()
    return sorted(r["reference"] for r in rows)


def test_token_counts():
    assert len(cite.short_forms()) == 307
    assert len(cite.testaments()) == 66
    assert sum(t == "OT" for t in cite.testaments().values()) == 39
    assert set(cite.short_forms().values()) <= set(cite.testaments())


CASES = {
    "Gen.1:1": ["Genesis 1:1"],
    "Gen.. 2:3": ["Genesis 2:3"],
    "1John 4:8": [],
    "1st John 2:2": ["John 2:2"],
    "1  John 2:2": ["John 2:2"],
    "1 John 2:2": ["1 John 2:2"],
    "III John 1:4": ["3 John 1:4"],
    "John 3:16-4:2": ["John 3:16-4"],
    "John 3:1616": ["John 3:161"],
    "John 3:16–18": ["John 3:16"],
    "John\u00a03:16": ["John 3:16"],
    "Song of Sol. 2:1": ["Song of Solomon 2:1"],
    "Mr. 5:3 and Is 2:3": ["Isaiah 2:3", "Mark 5:3"],
    "Genesisology 1:1": [],
    "Q2:255": ["S. 2:255"],
    "S. 2:255-257": ["S. 2:255-257"],
    "S. 115:1 S. 2:301 S. 2:10-5": [],
    "Quran 2:154 s. 2:1": [],
    "SS 2:3": ["Song of Solomon 2:3"],
}


@pytest.mark.parametrize("text", CASES)
def test_citation_forms(spark, text):
    assert references(spark, text) == CASES[text]


def test_every_token_is_found_with_its_book(spark):
    forms = {**{b: b for b in cite.testaments()}, **cite.short_forms()}
    rows = [(i, f"see {t} 3:4-5, end", b) for i, (t, b) in enumerate(forms.items())]
    df = spark.createDataFrame(rows, "id int, content string, book string")
    found = {r["article_id"]: r["book"] for r in index.extract_citations(df).collect()}
    assert found == {i: b for i, _, b in rows}


def test_pattern_equals_plain_alternation(spark):
    """The grouped pattern against one long alternation, on texts of random tokens."""
    import random

    tokens = sorted(set(cite.testaments()) | set(cite.short_forms()), key=len, reverse=True)
    plain = re.compile(
        rf"(?<!\w)({'|'.join(map(re.escape, tokens))})(?!\w)\.?\s*(\d{{1,3}}):(\d{{1,3}})(?:-(\d{{1,3}}))?",
        re.ASCII,
    )
    rng = random.Random(7)
    joints = [" ", "  ", ".", ". ", "", "x", "1", ", "]
    texts = [
        "".join(
            rng.choice(tokens) + rng.choice(joints) + f"{rng.randint(0, 1200)}:{rng.randint(0, 1200)}"
            + rng.choice(["", "-", "-7", "-1234"]) + rng.choice(joints)
            for _ in range(4)
        )
        for _ in range(1500)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    found = {r["id"]: r["m"] for r in df.select("id", cite.cited_bible(F.col("content")).alias("m")).collect()}
    for i, text in enumerate(texts):
        assert found[i] == [m[0] for m in plain.finditer(text)], text


def test_index_keeps_every_occurrence(spark):
    texts = [(i, "John 1:1; Q 2:5 " * (i % 3 + 1)) for i in range(30)]
    junction = index.count_per_article(
        index.extract_citations(spark.createDataFrame(texts, "id int, content string"))
    ).cache()
    assert junction.agg(F.sum("occurrence_count")).first()[0] == sum(2 * (i % 3 + 1) for i in range(30))
    verses = index.verse_table(junction)
    linked, unknown = index.link_verses(junction, verses)
    assert linked.count() == junction.count() and unknown.count() == 0
    assert index.quran_verses(verses).first()["reference"] == "S. 2:5"
    top = index.top_verses(junction, 1).first()
    assert (top["total_occurrences"], top["article_count"]) == (60, 30)


def test_top_labels_fall_back_to_ids(spark):
    linked = spark.createDataFrame([("a", "v1", None), ("b", "v1", 2), ("a", "v2", 1)],
                                   "article_id string, verse_id string, occurrence_count int")
    verses = spark.createDataFrame([("v1", "S. 1:1", "Opening")], "id string, reference string, surah_name string")
    assert [tuple(r) for r in index.top_linked(linked, verses).orderBy(F.desc("citations")).collect()] == [
        ("S. 1:1 (Opening)", 3),
        ("v2", 1),
    ]
