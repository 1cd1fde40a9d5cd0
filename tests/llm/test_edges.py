"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from folioflow.llm import bpe_stream, html_ttr, license_scan, ngram_jaccard, packing, pii_disclosure, quality_mcd, sharding, telephony, toxicity_gru

LONG = "word" * 30_000 + " " + "ab cd\n" * 20_000 + "é日" * 500
WORDS = "one two three four five six seven eight nine ten eleven twelve. " * 3
ROWS = [(1, WORDS, "en", "a"), (2, WORDS, "en", "a"), (3, "", None, None), (4, None, "de", "b"), (5, LONG, "en", None), (6, " \n\t", "fr", "c"), (7, WORDS, "en", "a"), (7, WORDS, "en", "a")]
LABELS = [(1, 0), (2, 1), (None, 1), (4, None)]

OPERATORS = {
    "quality": quality_mcd.judge,
    "pii": pii_disclosure.report,
    "jaccard": ngram_jaccard.join,
    "telephony": lambda d: telephony.features(telephony.decode(telephony.store(d))),
    "licenses": license_scan.scan,
    "packing": packing.pack,
    "bpe": bpe_stream.round_trip,
    "sharding": sharding.shard,
    "toxicity": lambda d: toxicity_gru.classify(d, d.sparkSession.createDataFrame(LABELS, "doc_id long, toxic int")),
}


@pytest.fixture(scope="module")
def docs(spark):
    # Extra columns: one that clashes with results, and one that differs from text by case alone.
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return rows.select("*", F.lit("x").alias("n_words"), F.lit("y").alias("sequence_id"), F.lit("z").alias("row"), F.lit("w").alias("TEXT"))


@pytest.mark.parametrize("name", OPERATORS)
def test_edges(spark, docs, name):
    result = OPERATORS[name](docs).collect()
    ids = [r["doc_id"] for r in result]
    if name == "packing":
        assert set(ids) == {1, 2, 3, 4, 5, 6, 7}
    else:
        assert sorted(ids) == [1, 2, 3, 4, 5, 6, 7, 7]
    empty = OPERATORS[name](docs.where("false"))
    assert empty.collect() == [] and empty.columns


@pytest.mark.parametrize("name", OPERATORS)
def test_equal_texts_have_equal_results(docs, name):
    rows = {}
    for r in OPERATORS[name](docs.where("doc_id in (1, 2, 7)")).collect():
        found = {k: v for k, v in r.asDict().items() if k not in ("doc_id", "held_out", "shard", "depth", "class_id", "copy_id", "sequence_id", "offset")}
        rows.setdefault(r["doc_id"], found)
        assert rows[r["doc_id"]] == found
    assert len({repr(v) for v in rows.values()}) == 1


def test_all_null_row(spark):
    nothing = spark.createDataFrame([(None, None, None, None)], "doc_id long, text string, lang string, source string")
    for name, operator in OPERATORS.items():
        assert len(operator(nothing).collect()) == 1, name
    pages = spark.createDataFrame([(None, None, None), (1, "u", ""), (2, "u", "<p>a"), (2, "u", "<p>a")], "page_id long, url string, html string")
    assert sorted(r["text"] for r in html_ttr.extract(pages.withColumn("text", F.lit(1))).collect()) == ["", "", "a", "a"]
    assert html_ttr.extract(pages.where("false")).collect() == []


def test_rows_without_an_id_are_in_no_group(spark):
    rows = spark.createDataFrame([(None, WORDS), (None, WORDS), (4, WORDS), (None, ""), (5, WORDS)], "doc_id long, text string")
    got = sorted(map(tuple, ngram_jaccard.join(rows).select("doc_id", "class_id", "copy_id", "n_links", "n_words").collect()), key=repr)
    assert got == [(4, 4, 4, 1, 36), (5, 4, 4, 1, 36), (None, None, None, 0, 0), (None, None, None, 0, 36), (None, None, None, 0, 36)]
    assert sorted((r["doc_id"] or 0) for r in ngram_jaccard.one_of_each(rows).collect()) == [0, 0, 0, 4]


def test_stages_on_nothing(spark):
    """The pipeline's stages on an empty table and on rows without an id: none fails, and none drops a row for its missing id."""
    import corpus_pipeline

    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    nameless = spark.createDataFrame([(None, f"{WORDS} {i}" if i else None, "en", "a", 5) for i in range(4)], kinds)
    labels = spark.createDataFrame(LABELS, "doc_id long, toxic int")
    forms = [lambda d: toxicity_gru.clean_only(d, labels), quality_mcd.kept_only, ngram_jaccard.one_of_each, pii_disclosure.sanitise, packing.pack]
    assert len(forms) == len(corpus_pipeline.STAGES)
    for form in forms:
        assert form(nameless.where("false")).collect() == []
    assert ngram_jaccard.one_of_each(nameless).count() == pii_disclosure.sanitise(nameless).count() == 4
    assert packing.pack(nameless).agg(F.sum("length")).first()[0] > 4


def test_stage_forms_keep_the_columns(spark):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    full = spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame(LABELS, "doc_id long, toxic int")
    assert quality_mcd.kept_only(full).columns == names and pii_disclosure.sanitise(full).columns == names and toxicity_gru.clean_only(full, labels).columns == names
    once = ngram_jaccard.one_of_each(full)
    assert once.columns == names and sorted(r["doc_id"] for r in once.collect()) == [1, 3, 4, 5, 6]
    assert pii_disclosure.sanitise(full).where("text is null").count() == 1


def test_stored_tables_go(spark):
    import os

    from folioflow.llm import common

    with common.scratch(spark):
        inner = common.stored(spark.range(3), "test-inner")
        outer = common.stored(inner, "test-outer", outlives=True)
    assert not os.path.exists(inner.stored_path) and outer.count() == 3
    common.discard(outer)
    assert not os.path.exists(outer.stored_path)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from folioflow.llm import common

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())
    Context.master = "local[2]"
    assert common.shared_dir(Session()) == common.shared_dir(Session())


def test_ties(spark, docs):
    """What happens where an operator has to choose among equals."""
    rows = spark.createDataFrame([(i, WORDS, "en", "a") for i in (5, 3, 9)] + [(20, "x y z " * 30, "en", "a")], "doc_id long, text string, lang string, source string")
    # Equal distances: all kept or none. Equal similarity: the smallest id names the group.
    assert len({(r["distance"], r["kept"]) for r in quality_mcd.judge(rows).where("doc_id < 20").collect()}) == 1
    assert {r["class_id"] for r in ngram_jaccard.join(rows).where("doc_id < 20").collect()} == {3}
    # Words that are equally frequent: the result has no order of them.
    both = spark.createDataFrame([(1, "all rights reserved released under the mit license")], "doc_id long, text string")
    assert license_scan.scan(both).first()["labels"] == "all-rights-reserved,mit"
    # Words that reveal equally: all of them go.
    told = spark.createDataFrame([(i, f"alpha beta a{i}@x.example.org") for i in range(6)] + [(i, f"plain {i}") for i in range(10, 40)], "doc_id long, text string")
    assert {r["n_term"] for r in pii_disclosure.report(told).where("doc_id < 10").collect()} == {2}
    # Equal scores and equal sizes: one score a text; pages hold any of the equals.
    scores = toxicity_gru.classify(rows, spark.createDataFrame([(3, 1), (9, 0), (20, 0)], "doc_id long, toxic int")).where("doc_id < 20").collect()
    assert len({r["score"] for r in scores}) == 1
    same = spark.createDataFrame([(1, "z" * 10)] * 7, "doc_id long, text string")
    assert sorted((r["page"], r["shard_bytes"]) for r in sharding.shard(same, 25).collect()) == [(0, 20), (0, 20), (1, 20), (1, 20), (2, 10), (3, 20), (3, 20)]
    # Lines of equal ratio: all content.
    assert html_ttr.main_text("<div>aaa bbb</div><div>ccc ddd</div>") == "aaa bbb\nccc ddd"
    # Equal texts have equal ids and sounds, whichever row comes first.
    assert len({(r["ids_sha256"], r["n_tokens"]) for r in bpe_stream.round_trip(rows).where("doc_id < 20").collect()}) == 1
    assert len({r["feature"] for r in telephony.features(telephony.decode(telephony.store(rows))).where("doc_id < 20").collect()}) == 1
    assert {r["doc_tokens"] for r in packing.pack(rows).where("doc_id < 20").collect()} == {packing.pack(rows).where("doc_id = 3").first()["doc_tokens"]}


def test_bitmaps_are_broadcast_in_few_rows(spark):
    """A row of a broadcast holds many words of a bitmap, so the driver keeps little besides its bits."""
    from folioflow.llm import common

    wanted = spark.range(0, 30_000, 3).withColumnRenamed("id", "words")
    rows = common.bitmap(wanted, "words", 1 << 18).collect()
    assert len(rows) * common.ROW_WORDS == (1 << 18) // 64 and all(len(r["words"]) == common.ROW_WORDS for r in rows)
    told = common.marked(spark.range(30_000).withColumnRenamed("id", "words"), wanted, "words")
    assert told.columns == ["words", "maybe"] and told.count() == 30_000
    assert told.where("not maybe and words % 3 = 0").isEmpty() and told.where("maybe and words % 3 != 0").count() < 3_000
    assert common.marked(wanted, wanted.where("false"), "words").where("maybe").isEmpty()


def test_a_step_of_the_mcd_is_a_small_plan(spark, monkeypatch):
    """Moments are exact longs, a column chain is analysed once, and a count that is known is not taken again."""
    from folioflow.llm import common
    from folioflow.llm import quality_mcd as mcd

    values = [[40_000 + 7 * k + i * k * k % 11 for i in range(len(mcd.FEATURES))] for k in range(50)]
    rows = spark.createDataFrame([("p", *v) for v in values], "pool string, " + ", ".join(f"{c} long" for c in mcd.FEATURES))
    sums = rows.groupBy("pool").agg(*mcd._moments())
    assert {kind for name, kind in sums.dtypes if name != "pool"} == {"bigint"}
    assert sums.first()["s5_4"] == sum(v[5] * v[4] for v in values)
    told = mcd._factored(sums, ["pool"], 1.0)
    found, (i, j) = told.first(), (1, 0)
    exact = (50 * sum(v[i] * v[j] for v in values) - sum(v[i] for v in values) * sum(v[j] for v in values)) / 2500
    assert abs(found["l0_0"] * found["l1_0"] - exact) < 1e-6 * abs(exact)
    monkeypatch.setattr(type(told), "withColumn", None)
    monkeypatch.setattr(type(told), "withColumns", None)
    monkeypatch.setattr(type(told), "count", None)
    measured = mcd._distance(common.join_small(rows, told.drop("n"), "pool", count=1))
    assert abs(sum(r["d2"] for r in measured.collect())) > 0


def test_tables_past_the_limit_of_broadcasts_are_not_broadcast(spark, monkeypatch):
    """Spark takes a stored table of few bytes for small, and would send the driver all the copies that are made of its rows."""
    from folioflow.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 10)
    with common.scratch(spark):
        side = common.stored(spark.range(40).selectExpr("id as k", "id * 2 as told"), "test-side")
        rows = spark.range(1000).selectExpr("id % 50 as k", "id")
        for how, n in (("inner", 800), ("left", 1000)):
            met = common.join_small(rows, side, "k", how)
            assert "Broadcast" not in met._jdf.queryExecution().toString()
            assert sorted((r["id"], r["told"]) for r in met.collect()) == [(i, i % 50 * 2 if i % 50 < 40 else None) for i in range(1000) if how == "left" or i % 50 < 40]
            assert met.count() == n
