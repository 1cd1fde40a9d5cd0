"""Catalogue files to entities, merging, graphs and back."""

import csv
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from folioflow.operators import catalog, merge, triples, validate
from folioflow.plans import bgp, pipelines
from folioflow.sources import rdf, zipcsv


def cells(**given):
    base = {
        "作品ID": "1", "人物ID": "7", "役割フラグ": "著者", "作品名": "題", "作品名読み": "だい", "副題": "　", "作品著作権フラグ": "なし", "人物著作権フラグ": "なし", "公開日": "2001-02-03", "最終更新日": "2002-03-04",
        "テキストファイルURL": "http://www.lib.example/cards/7/files/1.zip", "テキストファイル修正回数": "2", "テキストファイル文字集合": "JIS X 0208", "テキストファイル最終更新日": "2003-01-01", "テキストファイル符号化方式": "ShiftJIS",
        "分類番号": "NDC K913 914", "初出": "「雑誌」1948（昭和23）年5月", "底本名1": "底\"本\"", "底本初版発行年1": "1950（昭和25）年", "底本出版社名1": "甲社、乙社", "姓": "夏\n目", "名": "某", "生年月日": "1867-02-09", "文字遣い種別": "新字新仮名",
    }
    return base | given


ROWS = [
    cells(),
    cells(**{"人物ID": "8", "役割フラグ": "翻訳者", "姓": "森", "作品名": "別題"}),
    cells(**{"作品ID": "2", "作品名": "第二", "XHTML/HTMLファイルURL": "http://www.lib.example/cards/7/files/2.html", "XHTML/HTMLファイル修正回数": "0", "XHTML/HTMLファイル文字集合": "Unicode", "XHTML/HTMLファイル最終更新日": "2003-01-01", "XHTML/HTMLファイル符号化方式": "UTF-8"}),
    cells(**{"作品ID": "", "公開日": "", "作品著作権フラグ": "?"}),
]


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    out = io.StringIO()
    writer = csv.DictWriter(out, catalog.COLUMNS, quoting=csv.QUOTE_ALL)
    writer.writeheader()
    writer.writerows([{c: r.get(c, "") for c in catalog.COLUMNS} for r in ROWS])
    path = tmp_path_factory.mktemp("catalogue") / "list.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("list.csv", "﻿" + out.getvalue())
    (path.parent / "list.csv").write_text("﻿" + out.getvalue(), encoding="utf-8", newline="")
    return path


@pytest.fixture(scope="module")
def pairs(spark, archive):
    return catalog.entities(zipcsv.read_zip(spark, str(archive))).cache()


def test_both_readers_agree(spark, archive):
    a, b = zipcsv.read_zip(spark, str(archive)), zipcsv.read_csv(spark, str(archive.parent / "list.csv"))
    a, b = (catalog.clean(x).orderBy("row_ix").collect() for x in (a, b))
    assert [r.asDict() | {"file": ""} for r in a] == [r.asDict() | {"file": ""} for r in b] and a[0]["姓"] == "夏\n目" and a[0]["副題"] is None


def test_parse_table_short_long_and_repeated():
    rows = list(zipcsv.parse_table("a,b,a\r\n1,2,3\r\n4\r\n5,6,7,8\r\n".encode()))
    assert rows == [{"a": "3", "b": "2"}, {"a": "4"}, {"a": "7", "b": "6"}]


def test_entities(pairs):
    first = pairs.orderBy("row_ix").first()
    work, person = first["work"], first["person"]
    assert work["work_id"] == "w1" and work["author"] == ["p7"] and work["translator"] is None and person["author_of"] == ["w1"]
    assert [s["encoding"] for s in work["sources"]] == ["SJIS"] and work["sources"][0]["revision_count"] == 2
    assert work["references"][0]["publisher"] == ["甲社", "乙社"] and work["references"][0]["parent"] is None
    assert [(c["category"], c["childrens"]) for c in work["class_codes"]] == [("913", True), ("914", False)]
    assert str(work["first_published"]) == "1948-05-01" and str(person["date_of_birth"]) == "1867-02-09" and work["subtitle"] is None


def test_parity_and_strict(spark, archive):
    rows = zipcsv.read_zip(spark, str(archive))
    third = catalog.entities(rows, parity=True).where("work.work_id = 'w2'").first()["work"]
    assert third["subtitle"] == "だい" and {s["format"] for s in third["sources"]} == {"text/plain"}
    with pytest.raises(Exception, match="not a"):
        catalog.entities(rows, strict=True).collect()


def test_merge_modes(pairs):
    works, persons = merge.merged_catalogue(pairs, "first")
    w = works.where("work_id = 'w1'").first()
    assert w["title"] == "題" and w["author"] == ["p7"] and w["translator"] == ["p8"]
    assert persons.where("person_id = 'p7'").first()["author_of"] == ["w1"]
    _, persons = merge.merged_catalogue(pairs, "collect")
    assert persons.where("person_id = 'p7'").first()["author_of"] == ["w", "w1", "w2"]
    with pytest.raises(ValueError):
        merge.merge(works, "work_id", "title", "other")


def test_merge_is_idempotent_and_depends_on_order_alone(spark):
    rows = spark.createDataFrame([("k", 2, "b", None), ("k", 1, None, None), ("k", 3, "c", "z"), ("l", 1, None, None)], "k string, i int, a string, b string")
    once = merge.merge(rows, "k", "i")
    assert {(r["k"], r["a"], r["b"]) for r in once.collect()} == {("k", "b", "z"), ("l", None, None)}
    again = merge.merge(once.withColumn("i", F.lit(0)), "k", "i")
    assert sorted(map(tuple, again.select("k", "a", "b").collect())) == sorted(map(tuple, once.select("k", "a", "b").collect()))
    assert sorted(map(tuple, merge.merge(rows.repartition(3), "k", "i").select("k", "a", "b").collect())) == sorted(map(tuple, once.select("k", "a", "b").collect()))


def test_union_and_links(pairs):
    works, persons = merge.merged_catalogue(pairs)
    both = merge.entity_union(works, persons)
    assert both.groupBy("kind").count().count() == 2 and both.count() == works.count() + persons.count()
    links = catalog.link_table(pairs)
    assert {tuple(r) for r in links.collect()} == {("w1", "p7", "author"), ("w1", "p8", "translator"), ("w2", "p7", "author"), ("w", "p7", "author")}


def test_rows_of_several_archives_keep_their_order(spark, tmp_path):
    for name, title in (("b.zip", "later"), ("a.zip", "earlier")):
        out = io.StringIO()
        writer = csv.DictWriter(out, catalog.COLUMNS)
        writer.writeheader()
        writer.writerow({c: v for c, v in cells(**{"作品名": title}).items()})
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("list.csv", out.getvalue())
    works, _ = merge.merged_catalogue(catalog.entities(zipcsv.read_zip(spark, str(tmp_path / "*.zip")).repartition(2)), "first")
    assert [r["title"] for r in works.collect()] == ["earlier"]


def test_violations(spark, archive):
    found = pipelines.catalogue_violations(zipcsv.read_zip(spark, str(archive)))
    rules = {r["rule"] for r in found.where("id = 'w'").collect()}
    assert {"work_id: given", "copyright_expired: required", "publishing_date: required"} <= rules
    assert found.where("id = 'w1'").count() == 0
    with pytest.raises(ValueError, match="absent"):
        validate.assert_schema(found, {"nothing": "int"})


@pytest.mark.parametrize("lists", ["multi", "list"])
def test_graph_round_trips(spark, archive, tmp_path, lists):
    graph = pipelines.catalogue_graph(zipcsv.read_zip(spark, str(archive)), list_mode=lists).cache()
    assert triples.validate_graph(graph).isEmpty()
    for form, read in (("ntriples", rdf.read_ntriples), ("turtle", rdf.read_turtle)):
        rdf.write_graph(graph, str(tmp_path / form), form, {"dc": triples.PREFIXES["dc"]} if form == "turtle" else None, single=True)
        back = read(spark, str(tmp_path / form))
        assert triples.same_graph(graph, back), (form, triples.graph_diff(graph, back).collect()[:4])
    changed = graph.where("o <> '第二'")
    assert [r["change"] for r in triples.graph_diff(graph, changed).collect()] == ["removed"]


def test_list_chain(spark):
    rows = spark.createDataFrame([("urn:x", ["a", "b"])], "id string, names array<string>")
    chain = triples.lift(rows, "id", mode="list")
    assert chain.where(F.col("p").endswith("first")).count() == 2 and chain.where(F.col("o") == triples.RDF + "nil").count() == 1 and chain.count() == 5
    assert triples.lift(rows, "id").count() == 2


def test_bgp(spark, archive):
    graph = pipelines.catalogue_graph(zipcsv.read_zip(spark, str(archive)))
    p = triples.predicate
    q = bgp.Query(["?work"], [("?work", p("author"), "?who"), ("?who", p("family_name"), "?name")], {"?name": "夏\n目"})
    assert {r["work"] for r in bgp.compile_query(graph, q).collect()} == {"urn:folioflow:w1", "urn:folioflow:w2", "urn:folioflow:w"}
    constant = bgp.Query(["?work"], [("?work", p("title"), '"第二"')])
    assert [r["work"] for r in bgp.compile_query(graph, constant).collect()] == ["urn:folioflow:w2"]
    with pytest.raises(ValueError):
        bgp.compile_query(graph, bgp.Query(["?nothing"], q.patterns))
    assert bgp.ordered([("?a", "p", "?b"), ("?c", "q", '"x"'), ("?b", "r", "?c")], {}) == [("?c", "q", '"x"'), ("?b", "r", "?c"), ("?a", "p", "?b")]


def test_closure(spark):
    rows = [("urn:a", "sub", "urn:b"), ("urn:b", "sub", "urn:c"), ("urn:c", "sub", "urn:d"), ("urn:x", "type", "urn:a")]
    graph = spark.createDataFrame([(*r, "iri", None, None) for r in rows], rdf.SCHEMA)
    assert {r["o"] for r in bgp.closure(graph, "sub", "type").collect()} == {"urn:a", "urn:b", "urn:c", "urn:d"}


def test_turtle_reader():
    text = '@prefix e: <urn:e/> .\n# note\ne:a a e:B ; e:p "x\\n\\"y\\u0041"@en , 3, 1.5 , true ; e:q [ e:r "z"^^e:t ] ; e:l ( e:x "y" ) .\n<urn:e/c> e:p """long "q" text""" .'
    found = list(rdf.parse_turtle(text))
    assert ("urn:e/a", "urn:e/p", 'x\n"yA', "literal", None, "en") in found and ("urn:e/a", triples.RDF + "type", "urn:e/B", "iri", None, None) in found
    assert any(t[2] == "z" and t[4] == "urn:e/t" for t in found) and any(t[2] == 'long "q" text' for t in found)
    assert sum(t[1] == triples.RDF + "first" for t in found) == 2 and any(t[2] == triples.RDF + "nil" for t in found)


def test_command_line(spark, archive, tmp_path, capsys):
    from folioflow import cli

    assert cli.main(["-i", str(archive), "-o", str(tmp_path / "out"), "-f", "ntriples", "--single"]) == 0
    assert rdf.read_ntriples(spark, str(tmp_path / "out")).count() > 20 and len(list((tmp_path / "out").glob("part-*"))) == 1
    with pytest.raises(SystemExit):
        cli.main(["-f", "other"])
