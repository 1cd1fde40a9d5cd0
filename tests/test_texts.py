"""Source texts, markup trees, sentences, TEI, revisions, streams, and the registered queries."""

import datetime
import subprocess
import xml.etree.ElementTree as ET
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioflow.operators import markup as M
from folioflow.operators import sentences, tei
from folioflow.sources import revisions, texts
from folioflow.streaming import flows

SF = "/root/testdata/sf0.001"


def tags(text, **options):
    return [(n[3], n[4], n[5]) for n in M.flatten(M.parse(text, **options))][1:]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("あの山《やま》", [("paragraph", None, {}), ("text", "あの", {}), ("ruby", None, {"reading": "やま"}), ("text", "山", {})]),
        ("あの｜山々《やま》", [("paragraph", None, {}), ("text", "あの", {}), ("ruby", None, {"reading": "やま"}), ("text", "山々", {})]),
        ("字［＃「字」に二重傍線］", [("paragraph", None, {}), ("text", "字", {}), ("emphasis", None, {"of": "字", "value": "二重傍線"})]),
        ("字［＃「字」の左に「よみ」のルビ］", [("paragraph", None, {}), ("text", "字", {}), ("left_ruby", None, {"of": "字", "value": "よみ"})]),
        ("字［＃「字」は大見出し］", [("paragraph", None, {}), ("text", "字", {}), ("style", None, {"of": "字", "value": "大見出し"})]),
        ("字［＃「字」は２段階大きな文字］", [("paragraph", None, {}), ("text", "字", {}), ("char_size", None, {"of": "字", "value": "２段階大きな文字"})]),
        ("字［＃「字」は底本では「宇」］", [("paragraph", None, {}), ("text", "字", {}), ("source_reading", None, {"of": "字", "value": "宇"})]),
        ("字［＃「字」はママ］", [("paragraph", None, {}), ("text", "字", {}), ("as_in_source", None, {"of": "字", "value": "ママ"})]),
        ("字［＃ルビの「じ」は底本では「し」］", [("paragraph", None, {}), ("text", "字", {}), ("source_reading", None, {"of": "じ", "value": "し", "in": "ruby"})]),
        ("［＃（ノ）］［＃一レ］", [("paragraph", None, {}), ("okuri", None, {"value": "ノ"}), ("return_mark", None, {"value": "一レ"})]),
        ("［＃地図（fig1.png、横100×縦２００）入る］", [("paragraph", None, {}), ("figure", None, {"of": "地図", "file": "fig1.png", "width": "100", "height": "200"})]),
        ("［＃割り注］a［＃改行］b［＃割り注終わり］", [("paragraph", None, {}), ("split_note", None, {}), ("text", "a", {}), ("line_break", None, {}), ("text", "b", {})]),
        ("［＃三字下げ］x", [("paragraph", None, {}), ("indent", None, {"n": "3"}), ("text", "x", {})]),
        ("［＃下げて、地より２字あきで］x", [("paragraph", None, {}), ("lowered_bottom", None, {"n": "2"}), ("text", "x", {})]),
        ("［＃知らない］", [("paragraph", None, {}), ("note", None, {"value": "知らない"})]),
        ("［＃太字終わり］", [("paragraph", None, {}), ("unmatched_end", "［＃太字終わり］", {"of": "span"})]),
        ("［＃ここから2段組み、段間に罫］\na\n［＃ここで段組み終わり］", [("column_block", None, {"n": "2", "rule": "true"}), ("paragraph", None, {}), ("text", "a", {})]),
        ("［＃ここから改行天付き、折り返して１字下げ］\na\n", [("indent_block", None, {"n": "1", "flush": "true"}), ("paragraph", None, {}), ("text", "a", {})]),
        ("［＃「x《y》」の注記］［", [("paragraph", None, {}), ("note", None, {"value": "「x《y》」の注記"}), ("text", "［", {})]),
        ("［＃ここから太字］\na\n［＃ここで太字終わり］\nb", [("style_block", None, {"value": "太字"}), ("paragraph", None, {}), ("text", "a", {}), ("paragraph", None, {}), ("text", "b", {})]),
        ("※［＃「てへん」］《よみ》", [("paragraph", None, {}), ("ruby", None, {"reading": "よみ"}), ("glyph", None, {"value": "「てへん」"})]),
        ("a\n\nb", [("paragraph", None, {}), ("text", "a", {}), ("paragraph", None, {}), ("paragraph", None, {}), ("text", "b", {})]),
        ("", []),
    ],
)
def test_markup(text, expected):
    assert tags(text) == expected


def test_whole_run_option():
    assert tags("あの山《やま》", whole_run=True) == [("paragraph", None, {}), ("ruby", None, {"reading": "やま"}), ("text", "あの山", {})]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="山あ《》｜［＃］※〔〕a\n「」に傍点太字終わりここから2字下げ", max_size=60))
def test_markup_accepts_anything_and_offsets_nest(text):
    nodes = list(M.flatten(M.parse(text)))
    by_id = {n[0]: n for n in nodes}
    for node_id, parent, _, tag, content, _, start, stop in nodes:
        assert 0 <= start <= stop <= len(text)
        if tag == "text":
            assert content == text[start:stop]
        if parent >= 0:
            assert by_id[parent][0] < node_id


def test_markup_column(spark):
    rows = spark.createDataFrame([(1, "山《やま》"), (2, None), (3, "")], "k int, t string")
    nodes = M.parse_column(rows, "k", "t")
    assert {r["k"]: r["n"] for r in nodes.groupBy("k").agg(F.count("*").alias("n")).collect()} == {1: 4, 3: 1}


def test_sentences(spark):
    rows = spark.createDataFrame([(1, "ﾊﾛｰ。はい！\n\n終"), (2, None), (3, "")], "k int, t string")
    found = [tuple(r) for r in sentences.parse_paragraphs(rows, "k", "t").orderBy("k", "para", "sent").collect()]
    assert found == [(1, 0, 0, "ハロー。"), (1, 0, 1, "はい！"), (1, 1, 0, "終")]
    assert [tuple(r)[1:] for r in sentences.extent(rows, "k", "t").orderBy("k").collect()] == [(10, 2, 3), (0, 0, 0), (0, 0, 0)]


def test_tei(spark):
    header = "named_struct('title', 'A & <b>', 'authors', array('x', 'y'), 'editors', array('e'), 'extent', named_struct('character_count', 5L, 'suw_count', 2L, 'paragraph_count', 1L, 'sentence_count', 1L), 'publications', array(named_struct('publisher', 'P', 'distributor', 'D', 'availability', 'free', 'date', date'2019-12-30', 'idno', cast(null as string))), 'source_description', 's', 'responsibilities', array(named_struct('resp', 'typing', 'names', array('n1', 'n2'))), 'factuality_type', 'fictional', 'class_codes', array(named_struct('category', '913', 'childrens', true)), 'text_type', 'novel', 'derivation_type', 'original', 'constitution_type', 'single', 'purpose_type', 'entertain', 'purpose_degree', 'high', 'changes', array(named_struct('when', date'2020-01-02', 'who', '#me')))"
    rows = spark.createDataFrame([(1, "He said <x>. Yes\nTwo")], "k int, t string")
    doc = sentences.document(rows, "k", "t", ".", "").select(tei.tei(tei.header(F.expr(header).cast(tei.HEADER)), tei.body(F.col("paragraphs"))).alias("xml"))
    ns = {"t": tei.NAMESPACE}
    root = ET.fromstring(doc.first()["xml"])
    assert root.findtext(".//t:titleStmt/t:title", namespaces=ns) == "A & <b>" and [a.text for a in root.findall(".//t:author", ns)] == ["x", "y"]
    date = root.find(".//t:publicationStmt/t:date", ns)
    assert date.get("when") == "2019-12-30" and date.text == "December 30, 2019"
    assert root.findtext(".//t:classCode", namespaces=ns) == "K913" and root.find(".//t:change", ns).get("who") == "#me" and [n.text for n in root.findall(".//t:name", ns)] == ["n1", "n2"]
    assert [[s.text for s in p.findall("t:s", ns)] for p in root.findall(".//t:body/t:div/t:p", ns)] == [["He said <x>.", "Yes"], ["Two"]]
    q = spark.range(1).select(tei.quotation(F.lit("hi"), F.lit("spoken"), F.lit(True), F.lit(None).cast("boolean"), F.lit(True)).alias("a"), tei.quotation(F.lit("hi"), F.lit(None).cast("string"), F.lit(False), F.lit(True), F.lit(None).cast("boolean")).alias("b")).first()
    assert q["a"] == '<quote type="spoken" direct="true">hi</quote>' and q["b"] == '<q aloud="true">hi</q>'


def test_tei_files(spark, tmp_path):
    from folioflow.plans import pipelines

    docs = spark.createDataFrame([(1, "A. B\nC"), (2, None), (3, "x\ty & z")], "k int, t string")
    made = pipelines.tei_documents(docs, "k", "t", F.lit("T"), terminators=".", closers="")
    for r in made.collect():
        ET.fromstring(r["xml"])
    tei.write(made, str(tmp_path / "tei"))
    assert tei.read(spark, str(tmp_path / "tei")).count() == 3
    tei.write(made.unionByName(made).coalesce(1), str(tmp_path / "one"))
    assert tei.read(spark, str(tmp_path / "one")).where("teiHeader is not null").count() == 6
    (tmp_path / "whole.xml").write_text(made.first()["xml"].replace("><", ">\n<"), encoding="utf-8")
    assert tei.read(spark, str(tmp_path / "whole.xml"), lines=False).count() == 1


def test_texts(spark, tmp_path, monkeypatch):
    body = "本文\r\nです"
    with zipfile.ZipFile(tmp_path / "1.zip", "w") as z:
        z.writestr("fig.png", b"\x00")
        z.writestr("A.TXT", body.encode("cp932"))
        z.writestr("b.txt", b"second")
    (tmp_path / "2.html").write_text("<p>é</p>", encoding="utf-8")
    (tmp_path / "3.zip").write_bytes(b"damaged")
    with zipfile.ZipFile(tmp_path / "4.zip", "w") as z:
        z.writestr("fig.png", b"\x00")
    assert texts.text_of("x.zip", (tmp_path / "1.zip").read_bytes(), "SJIS") == body
    assert texts.text_of("x.ZIP", (tmp_path / "4.zip").read_bytes(), "SJIS") is None and texts.text_of("x.zip", b"damaged", None) is None
    works = spark.createDataFrame(
        [("w1", [("http://www.lib.example/1.zip", "text/plain", "SJIS"), ("http://www.lib.example/2.html", "text/html", "UTF-8")]), ("w2", [("http://www.lib.example/3.zip", "text/plain", "SJIS")])],
        "work_id string, sources array<struct<url:string,format:string,encoding:string>>",
    )
    found = texts.extract_texts(spark, works, r"https?://www\.lib\.example", str(tmp_path))
    assert [tuple(r) for r in found.collect()] == [("w1", "http://www.lib.example/1.zip", "本文\nです")]
    monkeypatch.setattr(texts, "BROADCAST_RESOURCES", 0)
    assert found.collect() == texts.extract_texts(spark, works, r"https?://www\.lib\.example", str(tmp_path)).collect()
    read = {r["path"].rsplit("/", 1)[1]: r["text"] for r in texts.read_texts(spark, str(tmp_path), spark.createDataFrame([("1.zip", "SJIS")], "name string, encoding string")).collect()}
    assert read == {"1.zip": body, "2.html": "<p>é</p>", "3.zip": None, "4.zip": None}
    html = texts.extract_texts(spark, works, r"https?://www\.lib\.example", str(tmp_path), "text/html")
    assert [r["text"] for r in html.collect()] == ["<p>é</p>"]


def test_cache(spark, tmp_path):
    source = tmp_path / "etc.html"
    source.write_text("one")
    url = source.as_uri()
    first = texts.cached(url, str(tmp_path / "cache"))
    source.write_text("two")
    assert texts.cached(url, str(tmp_path / "cache")) == first and open(first).read() == "one" and first.endswith("-etc.html")
    rows = spark.createDataFrame([(url,), ("file:///nowhere/x",), (None,)], "url string")
    assert [r["path"] is None for r in texts.fetch(rows, str(tmp_path / "cache")).collect()] == [False, True, True]


def test_revisions(spark, tmp_path):
    def git(*args, at=0):
        subprocess.run(["git", "-C", tmp_path, "-c", "user.name=a", "-c", "user.email=a@b", *args], check=True, capture_output=True, env={"GIT_AUTHOR_DATE": f"{at} +0000", "GIT_COMMITTER_DATE": f"{at} +0000", "PATH": "/usr/bin:/bin:/usr/local/bin"})

    git("init", "-q")
    for i, text in enumerate(["one\n", "one\ntwo\n", "one\ntwo\nthree\n"]):
        (tmp_path / "f.txt").write_text(text)
        git("add", "f.txt")
        git("commit", "-qm", f"c{i}", at=1_000_000_000 + i * 1000)
    git("tag", "v1")
    lines = revisions.read_revisions(spark, str(tmp_path), ["f.txt"])
    assert [r["line"] for r in revisions.file_log(lines).collect()] == ["three", "two", "one"]
    at = lambda i: F.lit(datetime.datetime.fromtimestamp(1_000_000_000 + i * 1000, datetime.timezone.utc))
    assert sorted(r["line"] for r in revisions.time_span(lines, "author_ts", at(0), at(2)).collect()) == ["three", "two"]
    assert revisions.read_log(spark, str(tmp_path)).count() == 3 and revisions.current_tag(spark, str(tmp_path)).first()["tag"] == "v1"


def test_repository_writing(tmp_path, monkeypatch):
    for k, v in {"GIT_AUTHOR_NAME": "a", "GIT_AUTHOR_EMAIL": "a@b", "GIT_COMMITTER_NAME": "a", "GIT_COMMITTER_EMAIL": "a@b"}.items():
        monkeypatch.setenv(k, v)
    repo = revisions.open_repository(str(tmp_path / "out"))
    (tmp_path / "out" / "x.xml").write_text("<x/>")
    first = revisions.commit(repo, "first", "v1")
    assert revisions.commit(repo, "nothing new") == first and [t[0] for t in revisions.tags(repo)] == ["v1"] and revisions.open_repository(repo) == repo


def test_streams(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("ts", "event_type").limit(400)
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    counted = flows.counts_by_window(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type", "1 day")
    q = counted.writeStream.outputMode("complete").format("memory").queryName("counted").start()
    q.processAllAvailable()
    q.stop()
    expected = events.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.window("ts", "1 day").alias("w"), "event_type").count()
    assert spark.table("counted").agg(F.sum("n")).first()[0] == 400 and spark.table("counted").count() == expected.count()


def test_registered_queries_match_sql(spark):
    import os

    import duckdb

    import __spark_entry__ as entry

    base = duckdb.connect()
    for name in os.listdir(SF):
        base.execute(f"create view {name.removesuffix('.parquet')} as select * from read_parquet('{SF}/{name}')")
    plain = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    from folioflow.plans import queries

    for name, sql in queries.ORACLE_SQL.items():
        ours = entry.queries()[name](spark, SF)
        columns = sorted(ours.columns)
        theirs = base.execute(f"select {', '.join(columns)} from ({sql})").fetchall()
        got = sorted(repr([plain(v) for v in r]) for r in ours.select(*columns).collect())
        assert got == sorted(repr([plain(v) for v in r]) for r in theirs), name
    assert entry.entry(spark).count() > 0
