"""Files, pages, videos, state, sinks and streams."""

import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from foliant import schemas
from foliant.functions.vectors import dimensions
from foliant.operators import articles, chunking, incremental
from foliant.session import shared_folder
from foliant.sinks import documents, reports
from foliant.sinks import tables as sink
from foliant.sources import encodings, files, snapshot, state, tables, videos, web
from foliant.streaming.arrivals import stream_missing

C = F.col


@pytest.fixture
def corpus(tmp_path):
    folder = tmp_path / "articles" / "01_first topic"
    folder.mkdir(parents=True)
    head = "# {}\n\n**Source:** [s](http://u/{})\n\n**Category:** 01 First\n\n---\n\n"
    (folder / "001_same_name.md").write_text(head.format("One", 1) + "word " * 60)
    (folder / "002_same_name.md").write_text(head.format("Two", 2) + "short")
    (folder / "003_50% + more.md").write_bytes(b"# T\xff\n---\nbody")
    (folder / "004_empty.md").write_text(" \n")
    (folder / "00_INDEX.md").write_text("# Index")
    (folder / "notes.txt").write_text("no article")
    other = tmp_path / "articles" / "99_unknown"
    other.mkdir()
    (other / "001_x.md").write_text("# X")
    return str(tmp_path / "articles")


def test_markdown_scan(spark, corpus):
    found = {r["path"]: r for r in files.read_markdown(spark, corpus).collect()}
    assert sorted(found) == [
        "01_first topic/001_same_name.md", "01_first topic/002_same_name.md",
        "01_first topic/003_50% + more.md", "01_first topic/004_empty.md", "99_unknown/001_x.md",
    ]
    assert found["01_first topic/003_50% + more.md"]["raw"] == "# T�\n---\nbody"
    assert files.count_files(spark, corpus + "/01_first topic") == 5


def test_articles_from_files(spark, corpus):
    scan = files.read_markdown(spark, corpus)
    built = articles.build_articles(scan)
    rows = {r["file_path"]: r for r in built.collect()}
    one = rows["01_first topic/001_same_name.md"]
    assert (one["slug"], one["word_count"], one["is_stub"]) == ("1-same_name-001", 60, False)
    assert one["category_slug"] == "first topic" and one["source_url"] == "http://u/1"
    assert one["content_html"].startswith("<p>word")
    assert rows["01_first topic/003_50% + more.md"]["slug"] == "1-50-more"
    summary = articles.ingest_summary(scan, built).first()
    assert tuple(summary) == (5, 4, 1, 3)


def test_readers_articles(spark, corpus):
    categories = spark.createDataFrame([(1, "first", "First")], "id int, slug string, name string")
    local = articles.load_local(files.read_markdown(spark, corpus), categories)
    rows = {r["file_path"]: r for r in local.collect()}
    assert len(rows) == 4
    assert rows["01_first topic/004_empty.md"]["title"] == "1-empty"
    assert rows["01_first topic/002_same_name.md"]["word_count"] == 9
    assert articles.summaries(local, 1).count() == 4 and articles.summaries(local, 2).count() == 0


def pages():
    return {
        "http://b/1": '<h3 class="post-title x"><a href="http://b/p1">First <b>post</b></a></h3>'
        '<h3 class="post-title"><a href="">none</a></h3><a href="http://b/q">no</a>'
        '<span id="blog-pager-older-link"><a class="z" href="http://b/2">Older</a></span>',
        "http://b/2": '<h2 class="post-title"><a href="http://b/p2">Second</a></h2>',
        "http://b/p1": '<h1 class="entry-title">Title one</h1><div class="post-body">' + "word " * 60
        + '<div>in</div></div><time>May</time>',
        "http://b/p2": '<div class="entry-content">too short</div>',
        "http://b/p3": "<p>nothing</p>",
    }


def fetcher():
    known = pages()

    def fetch(url):
        if url not in known:
            return web.Page(404, b"")
        return web.Page(200, known[url].encode("latin-1"), "latin-1")

    return fetch


def test_blog(spark):
    fetch = fetcher()
    assert web.follow_list("http://b/1", fetch) == ["http://b/1", "http://b/2"]
    listed = spark.createDataFrame([("http://b/1",), ("http://b/2",), ("http://b/none",)], "url string")
    fetched = web.fetch_pages(listed, fetch, pause=0)
    assert {r["url"]: r["html"] is None for r in fetched.collect()}["http://b/none"] is True
    posts = web.post_links(fetched)
    assert sorted(map(tuple, posts.collect())) == [("http://b/p1", "Firstpost"), ("http://b/p2", "Second")]
    more = posts.union(spark.createDataFrame([("http://b/p3", "Third")], "url string, title string"))
    visited = spark.createDataFrame([("http://b/p2",)], "url string")
    fresh = incremental.unvisited(more, visited)
    assert sorted(r["url"] for r in fresh.collect()) == ["http://b/p1", "http://b/p3"]
    kept = web.extract_posts(web.fetch_pages(fresh.select("url"), fetch, pause=0)).collect()
    assert [(r["title"], r["publish_date"], r["word_count"]) for r in kept] == [("Title one", "May", 61)]
    assert incremental.visited_after(visited, more).count() == 3


def test_fetch_retries():
    waits, calls = [], []

    def failing(error):
        def fetch(url):
            calls.append(url)
            if isinstance(error, int):
                return web.Page(error, b"")
            raise error

        return fetch

    for error, tries, waited in (
        (404, 1, []), (500, 3, [3, 6]), (TimeoutError(), 3, [3, 6]),
        (ConnectionError(), 3, [5, 10]), (ValueError(), 1, []),
    ):
        waits.clear(), calls.clear()
        assert web.fetch_with_retries(failing(error), "u", waits.append) is None
        assert (len(calls), waits) == (tries, waited)


@pytest.mark.parametrize(
    "body, given, text",
    [
        ("ü".encode(), None, "ü"), ("ü".encode("latin-1"), "latin-1", "ü"), (b"\xff", None, "ÿ"),
        ("\ufeffü".encode(), "latin-1", "ü"), ("ü".encode("utf-16"), None, "ü"), (b"x", "no-such", "x"),
        (b'<meta charset="iso-8859-1">\xfc', None, '<meta charset="iso-8859-1">ü'),
        (b"<meta http-equiv=x content='text/html; charset=windows-1252'>\x80", None,
         "<meta http-equiv=x content='text/html; charset=windows-1252'>€"),
    ],
)
def test_pages_are_decoded(body, given, text):
    assert web.decode_page(web.Page(200, body, given)) == text


def test_embedder_retries():
    waits, calls = [], []

    def limited(texts):
        calls.append(1)
        raise chunking.RateLimited

    with pytest.raises(chunking.RateLimited):
        chunking.call_embedder(limited, ["a"], sleep=waits.append)
    assert (len(calls), waits) == (3, [5.0, 10.0])


def test_embedding(spark):
    rows = [("1", "T", "text " * 1500, False), ("2", "U", "short", False), ("3", "V", "stub", True)]
    table = spark.createDataFrame(rows, "id string, title string, content string, is_stub boolean")
    stored = spark.createDataFrame([("2",)], "article_id string")
    todo = chunking.pending(table, stored)
    assert [r["id"] for r in todo.collect()] == ["1"]
    assert chunking.pending(table, stored, force=True).count() == 2
    chunks = chunking.chunk_articles(todo)
    # In a task, so it must not close over the test module.
    embedded = chunking.embed(chunks, chunking.digest_embedder(8), per_call=1, pause=0).orderBy("chunk_index").collect()
    assert [r["chunk_index"] for r in embedded] == list(range(chunks.count()))
    wanted = chunking.digest_embedder(8)([r["content"] for r in embedded])
    assert [r["embedding"] for r in embedded] == [v for _, v in wanted]


@pytest.mark.parametrize(
    "answer, right",
    [
        ([(1, [1.0]), (0, [0.0])], True), ([(0, [0.0])], False), ([(0, [0.0]), (0, [1.0])], False),
        ([(0, [0.0]), (2, [1.0])], False), ([(0, [0.0]), (1, [1.0, 2.0])], False), ([], False),
    ],
)
def test_answers_of_an_embedder_are_checked(answer, right):
    def call():
        return chunking.call_embedder(lambda texts: answer, ["a", "b"], dimensions=1)

    if right:
        assert call() == [[0.0], [1.0]]
    else:
        with pytest.raises(ValueError):
            call()


def test_chunk_table_is_refreshed_and_then_stays(spark):
    rows = [("1", "T", "text " * 1500, False), ("2", "U", "short text", False), ("3", "V", "stub", True)]
    articles = spark.createDataFrame(rows, "id string, title string, content string, is_stub boolean")
    stored = spark.createDataFrame(
        [("2", 0, "old", 1, [0.5] * 4)],
        "article_id string, chunk_index int, content string, token_count int, embedding array<float>",
    )
    refresh = lambda old, force=False: chunking.refresh(
        articles, old, chunking.digest_embedder(4), force, dimensions=4, pause=0
    )
    first = refresh(stored)
    assert {r["article_id"] for r in first.collect()} == {"1", "2"}
    assert [r["content"] for r in first.where("article_id = '2'").collect()] == ["old"]
    assert sorted(map(repr, refresh(first).collect())) == sorted(map(repr, first.collect()))
    forced = refresh(first, force=True)
    assert "old" not in {r["content"] for r in forced.collect()} and forced.count() == first.count()


def test_vector_lengths(spark):
    df = spark.createDataFrame([([1.0, 2.0], "[1,2,3]", 5)], "a array<float>, t string, n int")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    assert tuple(df.select(*[dimensions(C(c), kinds[c]) for c in "atn"]).first()) == (2, 3, -1)


def test_videos(spark):
    entries = spark.createDataFrame(
        [("a", "A", "", 1.0), (None, None, None, None), (None, "B", "http://v/b", None)],
        "id string, title string, url string, duration double",
    )
    listed = videos.listed_videos(entries)
    urls = sorted(r["video_url"] for r in listed.collect())
    assert urls == ["http://v/b", "https://www.youtube.com/watch?v=a"]
    info = spark.createDataFrame(
        [(urls[1], "The Quran", "on jihad", {"en": [("vtt", "u1")]}, {}), ("http://v/b", "Other", None, {}, {})],
        "video_url string, title string, description string, "
        "subtitles map<string, array<struct<ext: string, url: string>>>, "
        "automatic_captions map<string, array<struct<ext: string, url: string>>>",
    ).selectExpr(
        "*", "'20240101' upload_date", "1D duration", "'' thumbnail", "1L view_count"
    )
    enriched = videos.enrich_videos(info, lambda url: "WEBVTT\n\nHello\nHello\n")
    rows = {r["video_url"]: r for r in incremental.describe_videos(enriched, "2024-01-01T00:00:00Z").collect()}
    assert rows[urls[1]]["transcript"] == "Hello" and rows[urls[1]]["has_transcript"]
    assert rows[urls[1]]["matched_keywords"] == ["jihad", "quran"] and rows[urls[1]]["is_related"]
    assert rows["http://v/b"]["transcript"] == "" and not rows["http://v/b"]["is_related"]
    stored = spark.createDataFrame([("http://v/b",)], "video_url string")
    assert incremental.new_videos(listed, stored).count() == 1


def test_state(spark, tmp_path):
    assert state.stored_videos(spark, str(tmp_path / "none.json")).count() == 0
    path = tmp_path / "blog.json"
    path.write_text(json.dumps({"scraped_urls": ["a", "b"], "last_run": None}, indent=2))
    assert sorted(r["url"] for r in state.visited_urls(spark, str(path)).collect()) == ["a", "b"]


def test_lookups(spark):
    df = spark.createDataFrame([(1, "one"), (12, "twelve"), (12, "again")], "id int, slug string")
    assert tables.only_row(df, "id", 1)["slug"] == "one"
    for value in (12, 99):
        with pytest.raises(LookupError):
            tables.only_row(df, "id", value)
    assert tables.category_by_folder(df, "01_x").first()["slug"] == "one"
    assert tables.category_by_folder(df, "x").count() == 0
    assert tables.by_keys(df, "id", [12]).count() == 2


def test_tables_round_trip(spark, tmp_path):
    root, keys = str(tmp_path), ["slug"]
    first = spark.createDataFrame([("a", 1), ("b", 1)], "slug string, n int")
    second = spark.createDataFrame([("b", 2), ("c", 2)], "slug string, n int")
    sink.upsert(first, None, f"{root}/v1", keys, ["n"])
    sink.upsert(second, f"{root}/v1", f"{root}/v2", keys, ["n"])
    assert sorted(map(tuple, spark.read.parquet(f"{root}/v2").collect())) == [("a", 1), ("b", 2), ("c", 2)]
    for _ in range(2):
        sink.append_missing(second, f"{root}/v1", keys, ["n"])
    assert sorted(map(tuple, spark.read.parquet(f"{root}/v1").collect())) == [("a", 1), ("b", 1), ("c", 2)]
    chunks = spark.createDataFrame([("x", 0), ("x", 1), ("y", 0)], "article_id string, chunk_index int")
    sink.replace(chunks, f"{root}/c1")
    again = spark.createDataFrame([("x", 7)], "article_id string, chunk_index int")
    sink.replace_children(again, f"{root}/c1", f"{root}/c2")
    assert sorted(map(tuple, spark.read.parquet(f"{root}/c2").collect())) == [("x", 7), ("y", 0)]
    sink.replace_children(again, f"{root}/c1", f"{root}/c3", parents=chunks)
    assert sorted(map(tuple, spark.read.parquet(f"{root}/c3").collect())) == [("x", 7)]


def test_index_documents(spark, tmp_path):
    rows = [("02_b", 1, "T: one", "u1", "f1", False), ("02_b", 2, "Two", "u2", "f2", True), ("01_a", 1, "A", "u", "f", False)]
    links = spark.createDataFrame(
        rows, "folder string, position int, title string, url string, filename string, failed boolean"
    )
    lines = reports.category_index(links)
    text = [r["line"] for r in lines.where(C("folder") == "02_b").orderBy("line_no").collect()]
    assert text == ["# B", "", "Total articles: 2", "", "1. [T: one](f1)", "2. [FAILED] Two - u2"]
    master = reports.master_index(links, "All", "site")
    text = [r["line"] for r in master.orderBy("folder", "line_no").collect()]
    assert text == [
        "# All", "", "Source: site", "", "---", "", "## Table of Contents", "",
        "**Total: 3 articles across 2 categories**", "",
        "### [A](01_a/00_INDEX.md)", "*1 articles*", "", "  1. [A](01_a/001_a.md)", "",
        "### [B](02_b/00_INDEX.md)", "*2 articles*", "", "  1. [T: one](02_b/001_t_one.md)",
        "  2. [Two](02_b/002_two.md)", "",
    ]
    reports.write_lines(lines, str(tmp_path / "index"))
    parts = sorted((tmp_path / "index" / "folder=02_b").glob("part-*"))
    assert "".join(p.read_text() for p in parts).startswith("# B\n\nTotal articles: 2\n\n1. [T")
    reports.write_failures(links.where("failed"), str(tmp_path / "failed"))
    assert "02_b\tTwo\tu2\n" in "".join(p.read_text() for p in (tmp_path / "failed").glob("part-*"))
    catalog = spark.createDataFrame([("01_a",), ("02_b",), ("03_c",)], "folder string")
    counted = reports.counts_per_category(links, catalog).collect()
    assert {r["folder"]: r["n"] for r in counted} == {"01_a": 1, "02_b": 2, "03_c": 0}
    assert {r["total"] for r in counted} == {3}


def test_rows_are_sent_in_batches_and_records_written(spark, tmp_path):
    rows = spark.range(10, numPartitions=2).withColumn("v", F.col("id") * 2)
    folder = str(tmp_path / "sent")

    def send(batch):
        import os
        import uuid as ids

        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{ids.uuid4()}", "w") as file:
            file.write(f"{len(batch)} {sum(row['v'] for row in batch)}")

    sink.in_batches(rows, send, 3)
    sent = [tuple(map(int, p.read_text().split())) for p in (tmp_path / "sent").iterdir()]
    assert sorted(n for n, _ in sent) == [2, 2, 3, 3] and sum(v for _, v in sent) == 90
    reports.write_json(rows, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 10


def test_documents_are_written_once(spark, tmp_path):
    links = spark.createDataFrame(
        [("01_a", 1, "One", "http://mine.example/1"), ("01_a", 2, "Two", "http://other.example/2")],
        "folder string, position int, title string, url string",
    )
    placed = documents.place(links)
    assert sorted(r["filename"] for r in placed.collect()) == ["001_one.md", "002_two.md"]
    stored = spark.createDataFrame([("01_a", "001_one.md")], "folder string, filename string")
    assert [r["title"] for r in documents.missing_documents(placed, stored).collect()] == ["Two"]
    fetched = placed.withColumn("page_title", F.lit("")).withColumn("markdown", F.lit("body\n"))
    made = documents.article_documents(fetched, ["mine"])

    def put(path, text):
        from pathlib import Path

        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(text)

    documents.write_documents(made, str(tmp_path), put)
    assert Path(tmp_path, "01_a", "001_one.md").read_text() == (
        "# One\n\n**Source:** [http://mine.example/1](http://mine.example/1)\n\n**Category:** 01 A\n\n---\n\nbody\n"
    )
    assert "**External Link:**" in Path(tmp_path, "01_a", "002_two.md").read_text()


def test_posts_continue_the_numbering(spark):
    posts = spark.createDataFrame([(1, "Hello World"), (2, "???")], "position int, title string")
    placed = documents.place_posts(posts, existing=7)
    assert sorted(r["filename"] for r in placed.collect()) == ["008_hello_world.md", "009_article_9.md"]


def test_stream_appends_new_keys_once(spark, tmp_path):
    schema = "slug string, n int"
    source, target = (str(tmp_path / d) for d in ("in", "out"))
    name = f"arrivals-{uuid.uuid4()}"
    spark.createDataFrame([("a", 1)], schema).write.parquet(target)
    spark.createDataFrame([("a", 2), ("b", 2), ("b", 3)], schema).write.parquet(source)
    for _ in range(2):
        stream_missing(spark, name, source, target, schema, ["slug"], ["n"]).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [("a", 1), ("b", 2)]


def test_shared_folder_comes_from_the_session():
    class Session:
        def __init__(self, master, **settings):
            self.conf, self.sparkContext = settings, self
            self.master, self.applicationId = master, f"test-{master}"

    assert shared_folder(Session("spark://host", **{"spark.checkpoint.dir": "/shared/"})) == "/shared"
    own = shared_folder(Session("local[2]"))
    assert own.startswith("file:/") and shared_folder(Session("local[2]")) == own
    for master in ("spark://host", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError):
            shared_folder(Session(master))


def test_schemas_parse(spark):
    for name in dir(schemas):
        if name.isupper():
            assert spark.createDataFrame([], getattr(schemas, name)).count() == 0


ENCODED = {
    "windows-1252": "Les élèves français déjà à l’école – où est la forêt ? Größe und Übung",
    "windows-1250": "Zażółć gęślą jaźń, proszę przyjść później; příliš žluťoučký kůň",
    "windows-1251": "Привет, это обычный текст на русском языке. Москва — столица",
    "koi8-r": "Привет, это обычный текст на русском языке. Москва столица",
    "windows-1253": "Καλημέρα κόσμε, αυτό είναι ένα κείμενο",
    "windows-1255": "שלום עולם זה טקסט",
    "windows-1256": "السلام عليكم ورحمة الله وبركاته",
    "euc_kr": "안녕하세요 이것은 한국어 문장입니다",
    "shift_jis": "これは日本語の文章です。カタカナも含みます。",
    "euc_jp": "これは日本語の文章です。カタカナも含みます。",
    "gb18030": "这是一个中文句子，我们在这里测试编码的检测。",
    "big5": "這是一個中文句子，我們在這裡測試編碼的檢測。",
    "utf-8": "naïve 日本",
    "utf-16-le": "plain text é",
    "utf-16-be": "plain text é",
}


@pytest.mark.parametrize("encoding", ENCODED)
def test_encodings_are_found_from_bytes(encoding):
    text = "<p>" + ENCODED[encoding] + "</p>" if not encoding.startswith("utf-16") else ENCODED[encoding]
    body = text.encode(encoding)
    assert encodings.decode(body) == text and body.decode(encodings.detected(body)) == text


def test_statements_come_before_bytes():
    body = "<meta charset=koi8-r>é".encode("latin-1")
    assert encodings.encoding_of(body) == "koi8-r" and encodings.encoding_of(body, "utf-8") == "utf-8"
    assert encodings.encoding_of(b"\xff\xfe" + body) == "utf-16"
    assert encodings.decode("<meta charset=none-such>Größe".encode("latin-1")).endswith("Größe")
    assert encodings.decode(b"") == "" and encodings.detected(b"plain") == "utf-8"


def test_a_second_scan_reads_only_what_has_changed(spark, tmp_path):
    root, store = tmp_path / "articles", f"file://{tmp_path}/store"
    (root / "01_a").mkdir(parents=True)
    for i in range(12):
        (root / "01_a" / f"{i:03d}_x.md").write_text(f"text {i}")
    (root / "01_a" / "00_INDEX.md").write_text("index")
    scan = lambda: {r.filename: r.raw for r in snapshot.refresh(spark, f"file://{root}", store, 4).collect()}
    held = snapshot.BucketTable(spark, store, snapshot.SCHEMA, ["file"], 4)
    places = lambda: {e["bucket"]: e["path"] for e in held.entries()}
    assert scan() == {f"{i:03d}_x.md": f"text {i}" for i in range(12)} == {
        r.filename: r.raw for r in files.read_markdown(spark, f"file://{root}").collect()
    }
    before, version = places(), held.entries()[0]["version"]
    assert len(scan()) == 12 and held.entries()[0]["version"] == version
    (root / "01_a" / "003_x.md").write_text("changed text")
    (root / "01_a" / "004_x.md").unlink()
    (root / "01_a" / "099_x.md").write_text("new")
    found = {r.file.rsplit("/")[-1]: r.change for r in snapshot.differences(spark, f"file://{root}", held).collect()}
    assert found == {"003_x.md": "changed", "004_x.md": "gone", "099_x.md": "new"}
    after = scan()
    assert after["003_x.md"] == "changed text" and "004_x.md" not in after and after["099_x.md"] == "new" and len(after) == 12
    assert any(places()[b] == before[b] for b in before)


def test_chunks_of_gone_articles_and_new_stubs_go(spark):
    fields = "id string, title string, content string, is_stub boolean"
    text = "Some text of an article. " * 20
    both = spark.createDataFrame([("a", "A", text, False), ("b", "B", text, False), ("c", "C", text, False)], fields)
    none = spark.createDataFrame([], "article_id string, chunk_index int, content string, token_count int, embedding array<float>")
    run = lambda rows, old, **more: chunking.refresh(rows, old, chunking.digest_embedder(), pause=0, **more)
    first = spark.createDataFrame(run(both, none).collect(), none.schema)
    now = spark.createDataFrame([("a", "A", text, False), ("b", "B", "x", True)], fields)
    ids = lambda df: sorted({r.article_id for r in df.collect()})
    assert ids(first) == ["a", "b", "c"] and ids(run(now, first)) == ["a"] and ids(run(now, first, partial=True)) == ["a", "c"]


def test_posts_are_converted_once(spark):
    pages = spark.createDataFrame([("u", None), ("v", "<p>")], "url string, html string").repartition(2, "url")
    plan = web.extract_posts(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert web.extract_posts(pages).count() == 0
