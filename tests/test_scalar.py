"""Golden values of the cell normalisers, every branch."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions import scalar as S
from folioflow.functions import text as X


def values(spark, cells, expression, kind="string"):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    return [r["v"] for r in rows.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]


def test_blank_to_null(spark):
    cells = ["", " ", "\u3000", "\t\n", " a ", "\u00a0", None, "x", "\u2003 \u3000"]
    assert values(spark, cells, S.blank_to_null) == [None, None, None, None, " a ", "\u00a0", None, "x", None]


def test_to_integer(spark):
    cells = ["12", "１２", "+3", "-4", " 5", "x", "", None, "99999999999"]
    assert values(spark, cells, S.to_integer) == [12, 12, 3, -4, None, None, None, None, None]
    with pytest.raises(Exception, match="not an integer"):
        values(spark, ["x"], lambda c: S.to_integer(c, strict=True))


def test_to_url(spark):
    assert values(spark, ["http://a.example/x", "nothing", None], S.to_url) == ["http://a.example/x", None, None]
    with pytest.raises(Exception, match="not a URL"):
        values(spark, ["nothing"], lambda c: S.to_url(c, strict=True))


def test_iso_partial_date(spark):
    cells = ["2000-02-29", "2001-02-29", "1999-7", "1875", "20001013", "2000--5", "none", None, "2000-13-01"]
    assert values(spark, cells, lambda c: S.iso_partial_date(c).cast("string")) == ["2000-02-29", None, "1999-07-01", "1875-01-01", "2000-10-13", "2000-01-01", None, None, None]


def test_catalogue_date(spark):
    cells = {
        "不詳": None, "": None, " ": None, "「太陽　創刊号」": "1963-07-01", "昭和8年8月": "1933-08-01", "明治40年": "1907-01-01", "平成元年3月": None, "昭和八年八月": None,
        "1948（昭和23）年5月15日": "1948-05-15", "1935年1～3月": "1935-01-01", "1948(昭和23)年11月": "1948-11-01", "1867-02-09": "1867-02-09", "1900": "1900-01-01", "大正2年13月": None,
    }
    assert values(spark, list(cells), lambda c: S.catalogue_date(c).cast("string")) == list(cells.values())
    assert values(spark, ["1867-02-09"], lambda c: S.catalogue_date(c, iso_first=False).cast("string")) == ["1867-01-01"]
    assert values(spark, ["紀元前6世紀初"], lambda c: F.year(S.catalogue_date(c))) == [-600]


def test_choices(spark):
    assert values(spark, ["なし", "あり", "x", None], S.flag_to_boolean) == [False, True, None, None]
    assert values(spark, ["ShiftJIS", "EUC", "UTF-8", "x"], S.to_encoding) == ["SJIS", "EUC", "UTF-8", None]
    assert values(spark, ["著者", "その他", "x"], lambda c: S.inverse_relation(S.to_relation(c))) == ["author_of", "other_author_of", None]
    with pytest.raises(Exception, match="not a flag"):
        values(spark, [None], lambda c: S.flag_to_boolean(c, strict=True))


def test_class_codes(spark):
    codes = lambda c: F.transform(S.class_codes(c), lambda x: F.concat(F.when(x["childrens"], "K").otherwise(""), x["category"]))
    assert values(spark, ["NDC 913", "NDC K913", "NDC 913 914", "NDC K913 K914", "NDC 913K914", "NDC 913 913", "none", None], codes) == [["913"], ["K913"], ["913", "914"], ["K913", "K914"], ["913", "K914"], ["913"], None, None]
    assert values(spark, ["NDC 913 914"], lambda c: F.transform(S.class_codes(c, {"913": "novels"}), lambda x: x["category"])) == [["novels", "914"]]


def test_to_multiple(spark):
    assert values(spark, ["a、b", "a", "a、、b、、", "、", "", None], S.to_multiple) == [["a", "b"], ["a"], ["a", "", "b"], [], [""], None]
    assert values(spark, ["a、b"], lambda c: F.to_json(S.to_multiple(c, "name"))) == ['[{"name":"a"},{"name":"b"}]']


def test_names():
    assert S.camel_case("first_published") == "firstPublished" and S.pascal_case("work_id") == "WorkId"


def test_paths(spark):
    assert values(spark, ["/a/b.TXT", "/a/b", "/a/.hidden", "x.tar.gz"], S.extension) == [".txt", "", "", ".gz"]
    routed = values(spark, ["http://www.lib.example/cards/1/files/2.zip", "http://other.example/etc.html", "", None], lambda c: S.route(c, r"https?://www\.lib\.example", "/mirror"))
    assert routed[0] == "/mirror/cards/1/files/2.zip" and routed[1].endswith("-etc.html") and len(routed[1]) == 128 + 9 and routed[2:] == [None, None]


def test_lines_and_sentences(spark):
    assert values(spark, ["a\r\nb\n\nc\n\n", "", "\n"], X.split_lines) == [["a", "b", "", "c"], [], []]
    assert values(spark, ["これは。「そう？」はい！終", "。」"], X.sentences) == [["これは。", "「そう？」", "はい！", "終"], ["。」"]]
    assert values(spark, ["One. Two!? three"], lambda c: X.sentences(c, ".!?", "")) == [["One.", "Two!?", "three"]]
    assert values(spark, ["aB 1!"], X.to_full_width) == ["ａＢ　１！"]
    assert values(spark, ["カタカナー。", "かな", "「x」"], X.is_katakana) == [True, False, False]
    assert values(spark, ["「x」", "x"], X.has_quotation) == [True, False]


def test_flat_markup(spark):
    assert values(spark, ["青空文庫《あおぞらぶんこ》と｜読む人《よむひと》"], lambda c: F.transform(X.ruby_pairs(c), lambda p: F.concat_ws("/", p["base"], p["reading"]))) == [["青空文庫/あおぞらぶんこ", "読む人/よむひと"]]
    assert values(spark, ["｜山《やま》［＃「山」に傍点］※［＃二の字点、1-2-22］x"], X.strip_markup) == ["山x"]
    assert values(spark, ["［＃改ページ］a［＃地付き］"], X.annotations) == [["改ページ", "地付き"]]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=" \u3000\t\u00a0a、b", max_size=6), min_size=1, max_size=8))
def test_blank_to_null_is_idempotent(spark, cells):
    once = values(spark, cells, S.blank_to_null)
    assert values(spark, once, S.blank_to_null) == once
    assert all(v is None or v == c for v, c in zip(once, cells))


def test_small_expressions(spark):
    from folioflow.functions import text as X

    row = spark.range(1).select(
        S.is_url(F.lit("http://a.example/x")).alias("u"), S.is_url(F.lit("no")).alias("n"), S.is_url(F.lit(None).cast("string")).alias("z"),
        S.compact(F.struct(F.lit(None).cast("int").alias("a"), F.lit(None).cast("string").alias("b")), ["a", "b"]).alias("gone"),
        S.compact(F.struct(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b")), ["a", "b"]).alias("kept"),
        S.with_about(F.struct(F.lit(1).alias("a")), F.lit("urn:x")).alias("about"), S.date_literal(F.lit("2001-02-03").cast("date")).alias("date"),
        X.is_unknown(F.lit("未知")).alias("oov"), X.is_unknown(F.lit("既知")).alias("known"),
    ).first()
    assert (row["u"], row["n"], row["z"]) == (True, False, False) and row["gone"] is None and row["kept"]["a"] == 1
    assert row["about"].asDict() == {"a": 1, "about": "urn:x"} and row["date"] == "2001-02-03" and row["oov"] and not row["known"]


def test_nulls_go_from_the_inside_out(spark):
    kind = "a int, b struct<c:int,d:array<struct<e:string>>>, f array<int>, g struct<h:struct<i:int>>"
    rows = spark.createDataFrame([(1, (None, [("x",), (None,), None]), [None, 2], ((None,),)), (None, (None, None), None, ((None,),))], kind)
    whole = F.struct(*rows.columns)
    found = [r[0] for r in rows.select(S.without_nulls(whole, rows.schema)).collect()]
    assert found[1] is None and found[0]["a"] == 1 and [x["e"] for x in found[0]["b"]["d"]] == ["x"] and found[0]["f"] == [2] and found[0]["g"] is None
    assert spark.range(1).select(S.without_nulls(F.array(F.lit(None).cast("int")), T.ArrayType(T.IntegerType()))).first()[0] == []


def test_quotation_rules(spark):
    from folioflow.operators import validate

    rows = spark.createDataFrame([(1, "spoken"), (2, "sung"), (3, None)], "i int, type string")
    assert [r["i"] for r in validate.invalid(rows, validate.quotation_rules()).collect()] == [2]
    lists = spark.createDataFrame([(1, [1, 2]), (-1, [0]), (2, [])], "i int, xs array<int>")
    broken = [tuple(r["violations"]) for r in validate.validate(lists, [validate.non_negative("i"), validate.each("xs", "one", lambda x: x > 0)]).orderBy(F.abs("i"), "i").collect()]
    assert sorted(broken) == [(), (), ("i: not negative", "xs: every one")]
