import pytest
from pyspark.sql import functions as F

from foliant.functions import markup, report
from foliant.operators.formatting import format_html, format_markdown

C = F.col
OWNERS = ["Acme"]
SITES = {"acme": "Acme Press"}
FIELDS = "title string, markdown string, source_url string, category_id int, category_name string"


@pytest.fixture(scope="module")
def formatted(spark):
    def run(title, markdown, url="https://www.x-y.example/a", category=(1, "Test")):
        df = spark.createDataFrame([(title, markdown, url, *category)], FIELDS)
        return format_markdown(df, owners=OWNERS, sites=SITES).first()["formatted"]

    return run


def body(result):
    return result.split("---\n\n", 1)[1]


def test_html_article_is_valid(spark):
    df = spark.createDataFrame(
        [("Test", "<h2>Intro</h2><p>A <b>test</b> of <i>it</i>.</p>", "https://acme.example/t", 1, "Cat")],
        FIELDS.replace("markdown", "html"),
    )
    result = format_html(df, sites=SITES).select(
        "formatted", report.report(C("formatted")).alias("r")
    ).first()
    assert result["formatted"] == (
        "# Test\n\n**Source:** [Acme Press](https://acme.example/t)\n\n**Category:** 01 Cat\n\n---\n\n"
        "## Intro\n\nA **test** of _it_.\n"
    )
    assert result["r"]["valid"] and result["r"]["score"] == 100


def test_emphasis(formatted):
    result = formatted("Marks", "_**rain**_, __hail__, ****sleet****")
    assert body(result) == "***rain***, **hail**, **sleet**\n"


EMPHASIS = {
    "__**a**__": "**a**",
    "**__a__**": "**a**",
    "**_a_**": "***a***",
    "x__a__": "x__a__",
    "a ****** b": "a  b",
    "a ** ** b": "a  b",
    "a\n** \nb": "a\n\nb",
    "a\n  __\nb": "a\n\nb",
}


@pytest.mark.parametrize("text", EMPHASIS)
def test_emphasis_rules(one, text):
    assert one(markup.fix_emphasis(C("t")), t=text) == EMPHASIS[text]


def test_title_is_not_repeated(formatted):
    assert body(formatted("Lamps of the Harbour", "# Lamps of the Harbour\n\nThey are lit at dusk.")) == "They are lit at dusk.\n"
    assert "Abc" in body(formatted("Abc", "# Abc\n\ntext"))
    late = "\n".join(["x"] * 10) + "\nLamps of the Harbour"
    assert "Lamps of the Harbour" in body(formatted("Lamps of the Harbour", late))


def test_boilerplate(formatted):
    text = "The ferry left.\n\nPinterest\nTweet 12\nShare on\n\nCopyright Acme\n\nGod bless you all."
    assert body(formatted("Ferry", text)) == "The ferry left.\n"


def test_links(formatted):
    text = 'See [map](<http://m.example/a> "north") or [](http://m.example/b) or [legend]() [key](http://m/(k))'
    assert body(formatted("Links", text)) == "See [map](http://m.example/a) or  or legend [key](<http://m/(k)>)\n"


def test_capitals(formatted):
    assert formatted("A STORM AT SEA", "C.").startswith("# A Storm At Sea\n")
    assert formatted("LOW TIDE", "C.").startswith("# LOW TIDE\n")
    assert formatted("A [b]", "C.").startswith("# A \\[b\\]\n")


def test_rules(formatted):
    assert body(formatted("Tides", "Ebb\n\n_ _ _\n\nSlack\n\n* * *\n\nFlood")) == (
        "Ebb\n\n---\nSlack\n\n---\nFlood\n"
    )


def test_formatting_twice_changes_nothing(formatted):
    first = formatted("Twice", "One line of it.")
    assert formatted("Twice", first) == first


def test_unicode(formatted):
    assert body(formatted("Unicode", "a\u00a0b\u200bc\ufeffd\u2028e")) == "a bcd\ne\n"


def test_repeated_document(formatted):
    part = "".join(f"Buoy {i} was seen from the pier on a clear night, {i * 31} fathoms out.\n\n" for i in range(12))
    assert len(body(formatted("Buoys", part + part))) < len(part) * 1.1
    # Halves that only begin alike are no copies.
    begins = part + part[:505] + "".join(f"Gull {i} flew off {i * 17} times.\n\n" for i in range(30))
    assert "Gull 29" in body(formatted("Gulls", begins))
    other = "".join(f"Sentence number {i} differs from {i * 7919} others. " for i in range(40))
    assert len(body(formatted("No dup", other))) > len(other) * 0.9


def test_metadata_moves_to_the_header(formatted):
    result = formatted("Meta", "*Author: A. Writer*\n*Published: 2020*\n*Keyword: k*\nText")
    assert "**Author:** A. Writer\n\n**Date:** 2020\n\n---" in result
    assert body(result) == "Text\n"


def test_source_name_wins(spark):
    df = spark.createDataFrame([("T", "Text", "https://a.example", 3, "C", "Given")], FIELDS + ", source_name string")
    assert "**Source:** [Given](https://a.example)" in format_markdown(df).first()["formatted"]


def test_tables(one):
    assert one(markup.clean_tables(C("t")), t="|  | |\n| a |\n|  --  |\n| 1 |") == "\n| a |\n| -- |\n| 1 |"
    assert one(markup.clean_tables(C("t")), t="| a | b |\n| --- | --- |\n\nx") == "\nx"


def test_headings(one):
    text = "# Top\n## **Bold** \n#\n###### ****\n####### seven\nplain\n#"
    assert one(markup.normalize_headings(C("t")), t=text) == "## Top\n## Bold\n####### seven\nplain"
    assert one(markup.normalize_headings(C("t")), t="#") == ""


def test_report_lists_issues(one):
    bad = 'x\n**\n[](u) [a](b "c")\n\n\n\n****\u00a0\n Home | Back'
    result = one(report.report(C("t")), t=bad)
    kinds = [i.split(":")[0] for i in result["issues"]]
    assert kinds == [
        "MISSING_H1", "MISSING_SOURCE", "MISSING_CATEGORY", "ORPHAN_BOLD", "EMPTY_LINKS",
        "EXCESSIVE_BLANKS", "NBSP", "EMPTY_BOLD", "TOOLTIP_LINKS", "NAV_BOILERPLATE",
    ]
    assert not result["valid"] and result["score"] == 0 and result["line_count"] == 8
