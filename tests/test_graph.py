"""Inference, graph equality, the stored triple table, join orders, uneven joins and file-wise reading."""

import os
import random
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioflow.operators import components, inference, isomorphism, merge, sequences
from folioflow.operators.triples import COLUMNS, XSD
from folioflow.plans import bgp, joins
from folioflow.sources import rdf, texts
from folioflow.sources.triple_table import TripleTable

SCHEMA = rdf.SCHEMA
SF = "/root/testdata/sf0.001"


def graph_of(spark, rows):
    """Triples from (s, p, o): an object in quotes is a literal, one that begins with _: a blank node."""
    full = [(s, p, o.strip('"'), "literal" if o.startswith('"') else "blank" if o.startswith("_:") else "iri", None, None) for s, p, o in rows]
    return spark.createDataFrame(full, SCHEMA)


def plan_of(rows):
    return rows._jdf.queryExecution().toString()


# --- inference ---------------------------------------------------------------


def recursive(edges):
    con = duckdb.connect()
    con.execute("CREATE TABLE e (a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO e VALUES (?, ?)", edges)
    return set(con.sql("WITH RECURSIVE r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b) SELECT a, b FROM r").fetchall())


@pytest.mark.parametrize("name", ["chain", "diamond", "cycle", "random"])
def test_transitive_to_the_fixpoint(spark, name):
    r = random.Random(3)
    edges = {
        "chain": [(f"n{i}", f"n{i + 1}") for i in range(1000)],
        "diamond": [(f"n{i}", f"n{i + k}") for i in range(60) for k in (1, 2)] + [("n0", "n1")],
        "cycle": [(f"n{i}", f"n{(i + 1) % 50}") for i in range(50)] + [("x", "n7"), ("n9", "y"), ("z", "z")],
        "random": [(f"n{r.randrange(60)}", f"n{r.randrange(60)}") for _ in range(80)],
    }[name]
    rows = inference.transitive(spark.createDataFrame([*edges, (None, "n1"), ("n1", None)], "a string, b string")).collect()
    assert {(x["a"], x["b"]) for x in rows} == recursive(edges) and len(rows) == len({(x["a"], x["b"]) for x in rows})
    if name == "chain":
        assert all(x["distance"] == int(x["b"][1:]) - int(x["a"][1:]) for x in rows)


def test_types_of_a_deep_hierarchy(spark):
    told = [(f"urn:k{i}", "sub", f"urn:k{i + 1}") for i in range(60)] + [("urn:x", "type", "urn:k0"), ("urn:x", "type", '"urn:k0"')]
    types = bgp.closure(graph_of(spark, told), "sub", "type").where("o_kind = 'iri'").collect()
    assert {t["o"] for t in types} == {f"urn:k{i}" for i in range(61)} and len(types) == 61


@pytest.mark.parametrize("most", [0, 200_000])
def test_reach_of_starts_by_walks_and_by_rounds(spark, monkeypatch, most):
    """Walks by component and, beyond MOST_EDGES, rounds of joins give the same pairs and distances."""
    monkeypatch.setattr(inference, "MOST_EDGES", most)
    monkeypatch.setattr(inference, "FEW_EDGES", 10)
    monkeypatch.setattr(inference, "BLOCK", 5)
    r = random.Random(5)
    edges = [(100 * k + r.randrange(30), 100 * k + r.randrange(30)) for k in range(3) for _ in range(45)]
    starts = [(f"x{i}", r.choice(edges)[0]) for i in range(40)] + [("x1", edges[0][0]), ("x1", 999), (None, 1), ("y", None)]
    near = {}
    for a, b in edges:
        near.setdefault(a, []).append(b)
    want = {}
    for s, a in [x for x in starts if None not in x and any(x[1] in e for e in edges)]:
        want[s, a], level, n = 0, [a], 0
        while level:
            level, n = [b for x in level for b in near.get(x, []) if want.get((s, b), 1e9) > n + 1], n + 1
            want.update({(s, b): n for b in level})
    rows = inference.reached(spark.createDataFrame(starts, "s string, a long"), spark.createDataFrame(edges, "a long, b long"), own=True).collect()
    assert {(x["a"], x["b"]): x["distance"] for x in rows} == want and len(rows) == len(want)


def test_found_pairs_are_not_shuffled(spark):
    """A closure's pairs go from the walks to the reader with no exchange, and are a set as they come."""
    told = [(f"urn:k{i}", "sub", f"urn:k{(i + 1) % 50}") for i in range(50)] + [("urn:x", "type", "urn:k0"), ("urn:x", "type", "urn:k7"), ("urn:y", "type", "urn:other")]
    types = bgp.closure(graph_of(spark, told), "sub", "type")
    walked = plan_of(inference.transitive(spark.createDataFrame([("a", "b")], "a string, b string"))).split("== Physical Plan ==")[1]
    assert "Exchange" in walked and "Exchange" not in walked[: walked.index("FlatMapGroupsInArrow")]
    assert sorted((t["s"], t["o"]) for t in types.collect()) == sorted([("urn:x", f"urn:k{i}") for i in range(50)] + [("urn:y", "urn:other")])


def test_closure_files_go(spark, tmp_path):
    from folioflow.session import Workspace

    with Workspace(spark, "test") as space:
        rows = space.store(spark.range(5))
        kept = space.keep(rows)
        folder = space.folder
    assert not os.path.exists(folder.removeprefix("file:")) and kept.count() == 5


def brute_rdfs(facts):
    """The rules applied one at a time until nothing is new."""
    known = set(facts)
    while True:
        new = set()
        for s, p, o in known:
            for s2, p2, o2 in known:
                if p2 == inference.SUBPROPERTY and s2 == p:
                    new.add((s, o2, o))
                if p2 == inference.DOMAIN and s2 == p:
                    new.add((s, inference.TYPE, o2))
                if p2 == inference.RANGE and s2 == p and not o.startswith('"'):
                    new.add((o, inference.TYPE, o2))
                if (p, p2) in ((inference.TYPE, inference.SUBCLASS), (inference.SUBCLASS, inference.SUBCLASS), (inference.SUBPROPERTY, inference.SUBPROPERTY)) and s2 == o:
                    new.add((s, p, o2))
        if new <= known:
            return known
        known |= new


def test_rdfs_rules(spark):
    sub, prop, domain, range_, kind = inference.SUBCLASS, inference.SUBPROPERTY, inference.DOMAIN, inference.RANGE, inference.TYPE
    facts = [
        ("a", "wrote", "b"), ("a", "age", '"7"'), ("c", kind, "Novel"), ("wrote", prop, "made"), ("made", prop, "touched"), ("made", domain, "Maker"), ("touched", range_, "Thing"),
        ("Maker", sub, "Person"), ("Person", sub, "Agent"), ("Agent", sub, "Maker"), ("Novel", sub, "Book"), ("age", range_, "Number"), ("narrower", prop, sub), ("Poem", "narrower", "Novel"), ("d", kind, "Poem"),
        ("refines", prop, prop), ("painted", "refines", "made"), ("e", "painted", "f"), ("also", prop, domain), ("touched", "also", "Toucher"),
    ]
    got = {(r["s"], r["p"], f'"{r["o"]}"' if r["o_kind"] == "literal" else r["o"]) for r in inference.rdfs(graph_of(spark, facts)).collect()}
    assert got == brute_rdfs(facts)
    assert inference.rdfs(graph_of(spark, facts).where("false")).collect() == []


def test_components(spark):
    r = random.Random(4)
    edges = [(f"n{r.randrange(300)}", f"n{r.randrange(300)}") for _ in range(220)] + [(f"p{i:04}", f"p{i + 1:04}") for i in range(120)] + [("s", "s")]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = {x["node"]: x["component"] for x in components.components(spark.createDataFrame([*edges, (None, "n1")], "a string, b string")).collect()}
    assert got == {x: root(x) for x in list(parent)}


# --- graph equality ----------------------------------------------------------


def renamed(rows, seed=0):
    names = sorted({x for r in rows for x in (r[0], r[2]) if x.startswith("_:")})
    new = random.Random(seed).sample(range(1000), len(names))
    to = {n: f"_:r{k}" for n, k in zip(names, new)}
    return [(to.get(s, s), p, to.get(o, o)) for s, p, o in rows]


def ring(n, name):
    return [(f"_:{name}{i}", "next", f"_:{name}{(i + 1) % n}") for i in range(n)] + [(f"_:{name}{(i + 1) % n}", "next", f"_:{name}{i}") for i in range(n)]


NESTED = [("urn:a", "has", "_:x"), ("_:x", "title", '"t"'), ("urn:a", "has", "_:y"), ("_:y", "title", '"u"'), ("_:x", "part", "_:z"), ("_:y", "part", "_:z"), ("urn:a", "is", "urn:b"), ("_:z", "self", "_:z")]
ITEMS = [t for i in range(12) for t in ((f"_:l{i}", "first", '"v"'), (f"_:l{i}", "rest", f"_:l{i + 1}" if i < 11 else "urn:nil"))]


def test_isomorphism(spark):
    same = lambda a, b: isomorphism.isomorphic(graph_of(spark, a), graph_of(spark, b))
    twins = [(f"_:t{i}", "like", '"same"') for i in range(5)]
    every = NESTED + ITEMS + twins + ring(4, "q")
    assert same(every, renamed(every, 1)[::-1])
    assert not same(every, renamed(every[:-1], 1))
    assert not same(NESTED, [(s, p, '"v"' if o == '"u"' else o) for s, p, o in renamed(NESTED)])
    assert not same(NESTED, [*NESTED, ("urn:a", "is", "urn:c")])
    assert not same(NESTED, [(s, p, "_:x" if (s, p) == ("_:y", "part") else o) for s, p, o in NESTED])


def test_isomorphism_beyond_refinement(spark):
    """Colours can't tell a ring of six from two of three; the components and their forms can."""
    same = lambda a, b: isomorphism.isomorphic(graph_of(spark, a), graph_of(spark, b))
    assert not same(ring(6, "a"), ring(3, "b") + ring(3, "c"))
    assert same(ring(3, "a") + ring(3, "d"), ring(3, "b") + ring(3, "c"))
    # Two cubic graphs on six nodes: the prism and the complete bipartite one.
    both = lambda edges: [t for a, b in edges for t in ((f"_:{a}", "p", f"_:{b}"), (f"_:{b}", "p", f"_:{a}"))]
    prism = both([(0, 1), (1, 2), (2, 0), (3, 4), (4, 5), (5, 3), (0, 3), (1, 4), (2, 5)])
    bipartite = both([(a, b) for a in (0, 1, 2) for b in (3, 4, 5)])
    assert not same(prism, bipartite) and same(prism, renamed(prism, 5)) and same(bipartite, renamed(bipartite, 6))


@pytest.mark.parametrize("form", ["turtle", "ntriples"])
def test_isomorphism_of_a_round_trip(spark, tmp_path, form):
    graph = graph_of(spark, renamed(NESTED + ITEMS, 7))
    rdf.write_graph(graph, str(tmp_path / form), form)
    back = rdf.read_turtle(spark, str(tmp_path / form), several=True) if form == "turtle" else rdf.read_ntriples(spark, str(tmp_path / form))
    assert back.count() == len(NESTED + ITEMS)
    if form == "ntriples":
        assert isomorphism.isomorphic(back, graph_of(spark, NESTED + ITEMS))


# --- stored table and join orders --------------------------------------------


def test_triple_table(spark):
    rows = [(f"urn:s{i % 40}", f"http://x.example/p#{i % 3}", f"urn:o{i}") for i in range(300)]
    graph = graph_of(spark, rows)
    table = TripleTable(spark, buckets=4)
    try:
        assert table.add(graph.unionByName(graph)) == 300 and table.add(graph) == 0
        assert table.add(graph_of(spark, [rows[0], ("urn:new", "urn:q", '"x"'), ("urn:s1", rows[1][1], "urn:o900")])) == 2
        assert table.add(graph.where("false")) == 0
        assert table.add(graph.limit(1).select("s", F.lit("urn:q").alias("p"), "o", F.lit("literal").alias("o_kind"), F.lit(XSD + "date").alias("o_datatype"), "o_lang")) == 1
        assert sorted(map(tuple, table.read().where("p = 'http://x.example/p#1'").select("s", "p", "o").collect())) == sorted([x for x in rows if x[1].endswith("1")] + [("urn:s1", rows[1][1], "urn:o900")])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        star = bgp.compile_query(table.read(), bgp.Query(["?s", "?a", "?b"], [("?s", "http://x.example/p#0", "?a"), ("?s", "http://x.example/p#1", "?b")], distinct=False))
        plan = plan_of(star)
        assert "Exchange" not in plan.split("== Physical Plan ==")[1] and "PartitionFilters: [isnotnull(p" in plan
        want = [(s, o, o2) for s, p, o in rows if p.endswith("0") for s2, p2, o2 in [*rows, ("urn:s1", rows[1][1], "urn:o900")] if s2 == s and p2.endswith("1")]
        assert sorted(map(tuple, star.collect())) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        table.drop()
    assert not table.exists()


def test_a_stream_grows_a_table(spark, tmp_path):
    from folioflow.streaming import flows

    graph = graph_of(spark, [(f"urn:s{i}", f"urn:p{i % 2}", f"urn:o{i}") for i in range(20)])
    table = TripleTable(spark, buckets=2)
    try:
        # Each checkpoint begins anew, as after a loss: what comes again is there already.
        for folder, checkpoint, n in (("a", "c1", 20), ("a", "c2", 20), ("b", "c2", 23)):
            (graph if folder == "a" else graph_of(spark, [(f"urn:t{i}", "urn:p0", "urn:o") for i in range(3)])).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(graph.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
            flows.grow_table(stream, table, str(tmp_path / checkpoint)).awaitTermination()
            assert table.read().count() == n
    finally:
        table.drop()


def test_joins_by_cost(spark):
    """Of two patterns with two bound terms each the rare one leads, and the order avoids the large middle."""
    rows = [(f"urn:x{i}", "type", "urn:Thing") for i in range(500)] + [(f"urn:x{i}", "knows", f"urn:x{(i * 7) % 500}") for i in range(500)] + [("urn:x3", "name", '"Ada"'), ("urn:x4", "name", '"Bob"')]
    graph = graph_of(spark, rows)
    known = bgp.statistics(graph)
    assert known["type"].n == 500 and known["type"].objects == 1 and known["type"].common == {"urn:Thing": 500} and known["name"].subjects == 2
    patterns = [("?b", "type", "urn:Thing"), ("?a", "knows", "?b"), ("?a", "type", "urn:Thing"), ("?a", "name", '"Ada"')]
    assert bgp.ordered(patterns, {})[0] == patterns[0]
    order = bgp.ordered(patterns, {}, known)
    assert order[0] == patterns[3] and set(order[1:]) == set(patterns[:3]) and order.index(patterns[1]) < order.index(patterns[0])
    wanted = bgp.Query(["?a", "?b"], patterns)
    assert [tuple(r) for r in bgp.compile_query(graph, wanted, known).collect()] == [tuple(r) for r in bgp.compile_query(graph, wanted).collect()] == [("urn:x3", "urn:x21")]
    many = [(f"?v{i}", "knows", f"?v{i + 1}") for i in range(12)]
    assert sorted(bgp.ordered(many, {}, known)) == sorted(many)


def test_products_are_refused(spark):
    graph = graph_of(spark, [("a", "p", "b"), ("c", "q", "d")])
    apart = [("?x", "p", "?y"), ("?u", "q", "?v")]
    with pytest.raises(ValueError, match="product=True"):
        bgp.compile_query(graph, bgp.Query(["?x", "?u"], apart))
    assert bgp.compile_query(graph, bgp.Query(["?x", "?u"], apart, product=True)).count() == 1
    assert bgp.compile_query(graph, bgp.Query(["?x"], [("?x", "p", "?y"), ("c", "q", "d")])).count() == 1
    assert bgp.compile_query(graph, bgp.Query(["?x"], [("?x", "p", "?y"), ("c", "q", "e")])).count() == 0


def test_heavy_joins(spark):
    left = spark.createDataFrame([("hot" if i % 10 else f"k{i}", i) for i in range(400)] + [(None, 1)], "k string, a int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), *[(f"k{i}", i) for i in range(0, 400, 20)], *[("k20", i) for i in range(90)], (None, 2)], "k string, b int")
    keys = {r["k"]: r["_left"] for r in joins.heavy_keys(left, right, ["k"], 80).collect()}
    assert keys == {"hot": True, "k20": False}
    plain = sorted(map(tuple, left.join(right, ["k"]).collect()))
    assert sorted(map(tuple, joins.join_heavy(left, right, ["k"], 80, 4).collect())) == plain
    assert sorted(map(tuple, joins.join_heavy(left, right, ["k"]).collect())) == plain
    for most in (0, 1000):
        assert sorted(map(tuple, joins.join_counted(left, right, ["k"], most=most).collect())) == plain


# --- files -------------------------------------------------------------------


def files_read(rows):
    """Files that the scans of a plan that has run have opened."""
    total, nodes = 0, [rows._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        if "Scan binaryFile" in node.nodeName():
            total += node.metrics().apply("numFiles").value()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_extraction_opens_named_files_alone(spark, tmp_path):
    root = str(tmp_path)
    for i in range(50):
        os.makedirs(f"{root}/cards/{i}")
        with open(f"{root}/cards/{i}/te xt+é%{i}.txt", "w", newline="") as f:
            f.write(f"text {i}\r\nend")
    source = lambda i, form: [(f"https://h.example/cards/{i}/te xt+é%{i}.txt", form, "UTF-8")]
    works = spark.createDataFrame([("w7", source(7, "text/plain")), ("w8", source(8, "text/html")), ("w99", source(99, "text/plain")), ("w0", [])], "work_id string, sources array<struct<url:string,format:string,encoding:string>>")
    found = texts.extract_texts(spark, works, "https://h.example", root)
    assert [tuple(r) for r in found.collect()] == [("w7", "https://h.example/cards/7/te xt+é%7.txt", "text 7\nend")]
    named = texts.named_files(spark, root, spark.createDataFrame([(f"{root}/cards/7/te xt+é%7.txt",)], "path string"))
    assert named.collect()[0]["content"] == b"text 7\r\nend" and files_read(named) == 1
    assert texts.named_files(spark, root, works.select(F.col("work_id").alias("path")).where("false")).collect() == []


def test_extraction_in_several_scans(spark, tmp_path, monkeypatch):
    for i in range(9):
        os.makedirs(f"{tmp_path}/{i // 3}", exist_ok=True)
        (tmp_path / str(i // 3) / f"{i}.txt").write_text(str(i))
    wanted = spark.createDataFrame([(f"{tmp_path}/{i // 3}/{i}.txt",) for i in (0, 1, 2, 3, 4, 20)], "path string")
    for scan, most in ((2, 100), (100, 3)):
        monkeypatch.setattr(texts, "SCAN_PATHS", scan)
        monkeypatch.setattr(texts, "MOST_PATHS", most)
        assert sorted(r["content"] for r in texts.named_files(spark, str(tmp_path), wanted).collect()) == [b"0", b"1", b"2", b"3", b"4"]


ODD = ['a "q" \\ b', "line\nbreak\r\ttab .", "ends . ;\n    <x> .", "", "é日本 ^^<x> @en"]


def odd_graph(spark, hub=0):
    rows = [("urn:s", f"urn:p{i}", x, "literal", None, None) for i, x in enumerate(ODD)]
    rows += [("urn:s", "urn:q", "x", "literal", None, "en-GB"), ("urn:s", "urn:q", "5", "literal", XSD + "integer", None), ("_:b1", "urn:q", "_:b2", "blank", None, None), ("urn:t", "urn:q", "urn:s", "iri", None, None)]
    rows += [("urn:hub", "urn:q", f"urn:o{i}", "iri", None, None) for i in range(hub)]
    return spark.createDataFrame(rows, SCHEMA)


def test_turtle_of_hubs(spark, tmp_path):
    """A subject with many triples is written by several tasks, in several blocks; both readers see one subject."""
    graph = odd_graph(spark, 3000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rdf.write_graph(graph.unionByName(graph), str(tmp_path / "g"), "turtle", {"ex": "urn:"})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [f for f in os.listdir(tmp_path / "g") if f.startswith("part") and "<urn:hub> " in (tmp_path / "g" / f).read_text()]
    assert len(files) > 1
    for read in (rdf.read_turtle, rdf.read_turtle_blocks):
        assert sorted(map(repr, read(spark, str(tmp_path / "g")).select(*COLUMNS).collect())) == sorted(map(repr, graph.collect()))


def test_turtle_blocks_are_read_in_splits(spark, tmp_path):
    rdf.write_graph(odd_graph(spark, 20_000), str(tmp_path / "one"), single=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        back = rdf.read_turtle_blocks(spark, str(tmp_path / "one"))
        assert back.rdd.getNumPartitions() > 1
        assert back.count() == odd_graph(spark, 20_000).count() and back.exceptAll(rdf.read_turtle(spark, str(tmp_path / "one"))).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "other.ttl").write_text("@prefix a: <urn:> .\n<urn:s> a:p [ a:q 1 ] .\n")
    with pytest.raises(Exception, match="no statement in block form"):
        rdf.read_turtle_blocks(spark, str(tmp_path / "other.ttl")).collect()


def test_no_triples(spark, tmp_path):
    rdf.write_graph(odd_graph(spark).where("false"), str(tmp_path / "none"), prefixes={"ex": "urn:"})
    assert rdf.read_turtle_blocks(spark, str(tmp_path / "none")).collect() == []


# --- sequences and links -----------------------------------------------------


def shapes():
    letters = st.sampled_from("abc").map(lambda c: (c, sequences.one(lambda x, c=c: x == c)))

    def more(inner):
        joined = st.lists(inner, min_size=1, max_size=3)
        return st.one_of(
            joined.map(lambda x: ("".join(f"(?:{r})" for r, _ in x), sequences.cat(*[s for _, s in x]))), joined.map(lambda x: ("|".join(f"(?:{r})" for r, _ in x), sequences.alt(*[s for _, s in x]))),
            inner.map(lambda x: (f"(?:{x[0]})+", sequences.some(x[1]))), inner.map(lambda x: (f"(?:{x[0]})*", sequences.many(x[1]))), inner.map(lambda x: (f"(?:{x[0]})?", sequences.maybe(x[1]))),
        )

    return st.recursive(letters, more, max_leaves=6)


WORDS = ["", *[a + b + c + d for a in "abc" for b in ["", *"abc"] for c in ["", *"ab"] for d in ["", *"ac"]]]


@given(shapes())
@settings(max_examples=25, deadline=None)
def test_shapes_equal_regular_expressions(spark, shape):
    pattern, compiled = shape
    rows = spark.createDataFrame([(w, list(w)) for w in WORDS], "w string, x array<string>")
    got = rows.select("w", sequences.fits(F.col("x"), compiled).alias("ok"), sequences.first_misfit(F.col("x"), compiled).alias("at")).collect()
    for w, ok, at in got:
        assert ok == bool(re.fullmatch(pattern, w)), (pattern, w)
        assert (at is None) == ok and (at is None or 0 <= at <= len(w))


def test_shapes_of_nested_documents(spark):
    rows = spark.createDataFrame([(1, [(["x", "y"],), (["z"],)]), (2, [(["x"],), ([],)]), (3, []), (4, None), (5, [([""],)])], "id int, paragraphs array<struct<sentences:array<string>>>")
    rows = rows.withColumn("paragraphs", F.transform("paragraphs", lambda p: F.struct(F.transform(p["sentences"], lambda s: F.struct(s.alias("sentence"))).alias("sentences"))))
    told = rows.select("id", sequences.fits(F.col("paragraphs"), sequences.document_shape()).alias("ok"), sequences.first_misfit(F.col("paragraphs"), sequences.document_shape()).alias("at"))
    assert {tuple(r) for r in told.collect()} == {(1, True, None), (2, False, 1), (3, True, None), (4, None, None), (5, False, 0)}
    name, rule = sequences.sequence("paragraphs", sequences.document_shape())
    assert {r["id"] for r in rows.where(F.coalesce(rule, F.lit(False))).collect()} == {1, 3} and name == "paragraphs: of a shape"
    with pytest.raises(ValueError, match="at most"):
        sequences.fits(F.col("x"), sequences.cat(*[sequences.one(lambda x: x)] * 63))


def test_linked_chunks(spark):
    r = random.Random(9)
    rows = [(r.choice(["hub", "hub", "hub", "a", "b", None]), [f"l{r.randrange(400):03}" for _ in range(r.randrange(5))] + [None], i) for i in range(600)] + [("none", [], 0), ("null", None, 0)]
    table = spark.createDataFrame(rows, "id string, links array<string>, ix int")
    chunks = merge.linked_chunks(table, "id", "links", 50).collect()
    assert all(len(c["links"]) <= 50 for c in chunks)
    got = {}
    for c in sorted(chunks, key=lambda c: (c["id"], c["chunk"])):
        assert c["chunk"] == len(got.setdefault(c["id"], [])) / 50
        got[c["id"]] += c["links"]
    whole = merge.merge(table.where("id is not null"), "id", "ix", "collect").collect()
    assert got == {w["id"]: [x for x in w["links"] if x is not None] for w in whole if w["links"] and any(w["links"])}


def test_nodes_without_linked_nodes_are_dealt_out(spark, monkeypatch):
    """What is said of a blank node with a name or a literal meets no colours: the rows that a round joins all have a key."""
    told = [(f"_:x{i}", "p", f'"{i % 3}"') for i in range(60)] + [("_:x0", "q", "_:x1"), ("_:x3", "q", "_:x4")]
    frame = type(spark.range(1))
    join, keyless = frame.join, []

    def watched(self, other, on=None, how=None):
        if on == ["side", "other"]:
            keyless.append(self.where("other is null").count())
        return join(self, other, on, how)

    monkeypatch.setattr(frame, "join", watched)
    colours = {r["node"]: r["colour"] for r in isomorphism.blank_colours(graph_of(spark, told)).collect()}
    assert keyless and not any(keyless)
    assert len(colours) == 60 and len(set(colours.values())) == 5 and colours["_:x0"] == colours["_:x3"] != colours["_:x6"] and colours["_:x1"] == colours["_:x4"] != colours["_:x7"] == colours["_:x10"]


def test_every_order_has_a_colour(spark):
    """The query tells the classes of all orders and customers, not of a part of its table."""
    from folioflow.plans.queries import QUERIES

    read = lambda name, key: {r[0] for r in spark.read.parquet(f"{SF}/{name}.parquet").select(key).collect()}
    nodes = {r["node"] for r in QUERIES["blank_colours"](spark, SF).select("node").collect()}
    assert nodes == {f"_:o{k}" for k in read("orders", "o_orderkey")} | {f"_:c{k}" for k in read("customer", "c_custkey")}


def test_every_order_has_types(spark):
    """The query counts the types of all orders, not of a part of its table."""
    from folioflow.plans.queries import QUERIES

    told = {f"urn:o{r[0]}" for r in spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey").collect()}
    assert {r["s"] for r in QUERIES["inference_types"](spark, SF).select("s").collect()} == told


@pytest.mark.parametrize("most", [0, 200_000])
@pytest.mark.parametrize("own", [False, True])
def test_pairs_and_numbers_without_distances(spark, monkeypatch, most, own):
    """What goes once over the edges, with a bit a start, finds the pairs that walks from each start find."""
    monkeypatch.setattr(inference, "MOST_EDGES", most)
    monkeypatch.setattr(inference, "FEW_EDGES", 10)
    monkeypatch.setattr(inference, "WIDE", 7)
    monkeypatch.setattr(inference, "SPREAD", 32)
    r = random.Random(6)
    edges = [(100 * k + r.randrange(40), 100 * k + r.randrange(40)) for k in range(3) for _ in range(45)] + [(900, 900), (901, 902)]
    starts = [(f"x{i}", r.choice(edges)[0]) for i in range(50)] + [("x1", edges[0][0]), ("x1", 999), (None, 1), ("y", None), ("z", 900), ("z", 901), ("end", 902)]
    starts, edges = spark.createDataFrame(starts, "s string, a long"), spark.createDataFrame(edges, "a long, b long")
    want = [(x["a"], x["b"]) for x in inference.reached(starts, edges, own=own).collect()]
    assert len(want) == len(set(want)) and sorted(map(tuple, inference.linked(starts, edges, own=own).select("a", "b").collect())) == sorted(want)
    assert {a: n for a, n in inference.counts(starts, edges, own=own).collect() if n} == {a: sum(x == a for x, _ in want) for a, _ in want}


def test_numbers_of_types(spark):
    """A subject's number of types is that of its triples in the closure, whatever it is told; a hundred thousand subjects of a class make no triples each."""
    r = random.Random(8)
    told = [(f"urn:k{r.randrange(40)}", "sub", f"urn:k{r.randrange(40)}") for _ in range(60)] + [(f"urn:x{r.randrange(30)}", "type", f"urn:k{r.randrange(50)}") for _ in range(60)]
    told += [("urn:x1", "type", '"urn:k0"'), ("urn:only", "type", '"text"'), ("urn:other", "type", "urn:none"), ("urn:x2", "type", "urn:none")]
    want = {}
    for t in bgp.closure(graph_of(spark, told), "sub", "type").collect():
        want[t["s"]] = want.get(t["s"], 0) + 1
    assert dict(map(tuple, inference.type_counts(graph_of(spark, told), "sub", "type").collect())) == want
    chain = graph_of(spark, [(f"urn:k{i}", "sub", f"urn:k{i + 1}") for i in range(999)])
    many = spark.range(100_000).select(F.concat(F.lit("urn:x"), "id").alias("s"), F.lit("type").alias("p"), F.lit("urn:k0").alias("o"), F.lit("iri").alias("o_kind"), *[F.lit(None).cast("string").alias(c) for c in ("o_datatype", "o_lang")])
    found = inference.type_counts(chain.unionByName(many), "sub", "type")
    assert found.where("n = 1000").count() == 100_000
