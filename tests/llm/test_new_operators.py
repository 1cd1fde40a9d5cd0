"""Collocations, conversation repair and token counts against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm import collocations, conversations, exchange, token_counts

SF = "/root/testdata/sf0.001"
CLASHES = {"block": "x", "owner": "y", "words": "z", "TEXT": "w", "n_tokens": "v"}


def clashing(rows):
    from pyspark.sql import functions as F

    return rows.select("*", *[F.lit(v).alias(k) for k, v in CLASHES.items()])


# --- exchange ----------------------------------------------------------------


@given(st.lists(st.integers(0, 2**63 - 1), max_size=50))
@settings(max_examples=50, deadline=None)
def test_planes_round_trip(values):
    for kind in ("<u4", "<u8"):
        array = np.array([v % 2 ** (8 * np.dtype(kind).itemsize) for v in values], kind)
        assert exchange.from_planes(exchange.planes(array), kind).tolist() == array.tolist()


# --- collocations ------------------------------------------------------------


def brute_collocations(rows, least=10, inside=50, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    longer = collections.Counter()
    for (lang, *w), a in candidates.items():
        if len(w) == 3:
            for part in (w[:2], w[1:]):
                longer[lang, *part] = max(longer[lang, *part], a)
    found = collections.defaultdict(list)
    for (lang, *w), a in candidates.items():
        if len(w) == 2 and 100 * longer[lang, *w] >= inside * a:
            continue
        cuts = [(1_000_000 * a * a // (l * r), k, l, r) for k in range(1, len(w)) for l, r in [(f[lang, *w[:k]], f[lang, *w[k:]])]]
        score, _, l, r = min(cuts)
        found[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, x in found.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top], 1)}


def texts_of(seed, n, words):
    r = random.Random(seed)
    ends = [" ", "  ", "\t", ", ", ". ", "\n", "!? ", " \x0b"]
    return ["".join(r.choice(words) + r.choice(ends[:3] if r.random() < 0.8 else ends) for _ in range(r.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("hot", [collocations.HOT, 40])
def test_collocations_equal_counting(spark, monkeypatch, hot):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(collocations, "CODES", 100)
    rows = [(t, lang) for seed, lang in enumerate(["en", "de", None]) for t in texts_of(seed, 120, ["a", "B", "b", "the", "éa", "É", "x\x00y", "\x1c", "日本", "of", "#"])]
    rows += [(None, "en"), ("", None), (" \n", "zz"), ("Solo", "zz"), ("new york city " * 30, "en"), ("A A A A A A A A A A A A A A A A", "en")]
    docs = clashing(spark.createDataFrame(rows, "text string, lang string"))
    got = {tuple(r) for r in collocations.collocations(docs, fragments=200, hot=hot).collect()}
    assert got == brute_collocations(rows) and len(got) > 100
    few = {tuple(r) for r in collocations.collocations(docs, top=7, fragments=200, hot=hot).collect()}
    assert few == brute_collocations(rows, top=7)


def test_collocations_of_the_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    got = {tuple(r) for r in collocations.collocations(rows).collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == set(con.sql(collocations.oracle_sql()).fetchall()) == brute_collocations([(r["text"], r["lang"]) for r in rows.collect()])


def test_scores_are_exact(spark):
    """Products beyond 64 bits, and ties of the floors."""
    big = 999_999_999_999_999
    rows = spark.createDataFrame([(big, big, big), (big - 1, big, big), (3, 7, 9), (10, 10, 10)], "a long, l long, r long")
    for a, l, r, score in rows.select("a", "l", "r", collocations._score("a", "l", "r")).collect():
        assert score == 1_000_000 * a * a // (l * r)


def test_fragments_own_each_phrase_once():
    r = random.Random(1)
    for _ in range(200):
        ranks = np.array([r.choice([-1, 0, 1, 2, 3]) for _ in range(r.randrange(1, 25))], np.int32)
        rows, weights = collocations.merged(collocations.fragments_of(ranks))
        got = collections.Counter()
        for words, a in collocations.phrases_of((rows + 1).astype(np.uint64), weights) if len(rows) else ():
            got.update({tuple(w): int(n) for w, n in zip(words.tolist(), a)})
        line = (ranks + 1).tolist()
        spans = [tuple(line[i : i + k]) for k in (2, 3) for i in range(len(line) - k + 1)]
        assert got == collections.Counter(s for s in spans if 0 not in s)


def test_no_phrases(spark):
    docs = clashing(spark.createDataFrame([("one two", "en")], "text string, lang string"))
    assert collocations.collocations(docs).collect() == [] == collocations.collocations(docs.where("false")).collect()


# --- conversations -----------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = lambda x: " " if x is None else str(x)
        kind, role, text = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20, shown(role), shown(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def all_edits(rows):
    """Every sequence of edits whose roles fit, with up to three insertions in a place: (cost, audit, lines)."""
    found = []

    def go(i, cost, audit, lines, initials):
        if len(initials) > 14:
            return
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", initials):
                found.append((cost, audit, lines))
            for role in ("user", "assistant") if audit[-3:] != "III" else ():
                go(i, cost + 2, audit + "I", [*lines, role + ":"], initials + role[0])
            return
        role, text, fault = rows[i]
        go(i + 1, cost + 3, audit + "D", lines, initials)
        if fault in ("", "truncated"):
            more = fault == "truncated"
            go(i + 1, cost + more, audit + "K", [*lines, f"{role}:{text}"], initials + (role[:1] or "-"))
            for to in ("user", "assistant"):
                go(i + 1, cost + 2 + more, audit + "R", [*lines, f"{to}:{text}"], initials + to[0])
        for to in ("user", "assistant") if audit[-1:] != "I" else ():
            go(i, cost + 2, audit + "I", [*lines, to + ":"], initials + to[0])

    go(0, 0, "", [], "")
    return min(found)


def brute_repair(rows):
    out = {}
    by_conv = collections.defaultdict(list)
    for r in damage(rows):
        by_conv[r[0]].append(r)
    for conv in {r[0] for r in rows}:
        mine = sorted(by_conv[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        marked, seen = [], set()
        for _, _, role, text in mine:
            last = text.rstrip(SPACE)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [r[1] for r in mine if r[1] is not None]
        n = collections.Counter(f for _, _, f in marked)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, lines = all_edits(marked)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def some_conversations(seed, n):
    r = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "ubiquitous"]
    texts = ["Yes.", "No!", "open end", "", " \n", "é 日?", None, "a. b", "Yes. \t"]
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(r.randrange(1, 6)):
            rows.append((conv, r.choice([turn, turn, turn, turn + 2, turn - 1, None]), r.choice(roles), r.choice(texts)))
    return rows


@pytest.mark.parametrize("batch", [conversations.BATCH, 3])
def test_repair_equals_every_edit(spark, batch):
    rows = some_conversations(5, 60)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r[0]: tuple(r)[1:] for r in conversations.repair(clashing(table), batch).collect()}
    assert got == brute_repair(rows)


def test_repair_of_long_conversations(spark):
    """A conversation of many batches has the audit and digest that one batch gives it; so has the SQL."""
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", "system"]), f"{r.choice(['Yes', 'No'])} {t}{r.choice(['.', '', '!'])}") for c, n in ((1, 700), (2, 900), (3, 5)) for t in range(n)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = sorted(map(tuple, conversations.repair(table, 5000).collect()))
    assert sorted(map(tuple, conversations.repair(table, 64).collect())) == whole
    con = duckdb.connect()
    con.register("conversations", table.toPandas())
    assert sorted(con.sql(conversations.oracle_sql()).fetchall()) == whole


def test_settled_letters_leave():
    """What a long conversation holds back stays small."""
    import pyarrow as pa

    walker = conversations.Walker()
    names = ["conv_id", "turn", "role", "text", "present", "blank", "duplicate", "truncated", "illegal", "fresh"]
    for k in range(20):
        n = 50
        columns = [[7] * n, list(range(k * n, k * n + n)), ["user", "assistant"] * (n // 2), ["Yes."] * n, [True] * n, *[[False] * n] * 4, [True] * n]
        assert list(walker.take(pa.RecordBatch.from_pydict(dict(zip(names, columns))))) == []
        assert len(walker.open.rows) < 4
    (row,) = walker.finish()
    assert row[:7] == (7, 0, 0, 0, 0, 0, 0) and row[7] == "K" * 1000


def test_repair_of_nothing(spark):
    table = spark.createDataFrame([(1, None, None, None)], "conv_id long, turn long, role string, text string")
    assert conversations.repair(table.where("false")).collect() == []
    assert tuple(conversations.repair(table).first())[1:] == brute_repair([(1, None, None, None)])[1]
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = conversations.repair(spark.createDataFrame([(dropped, 0, "user", "x")], "conv_id long, turn long, role string, text string")).first()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# --- token counts ------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


def test_token_counts_equal_the_library(spark, monkeypatch, library):
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(token_counts, "ENTRIES", 500)
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += [None, "", " ", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "<|endoftex", "x" * 5000, "日本語 " * 50, "  \n\n\t  x  ", "'s're don't I'LL", " 　é́", "🙂🙂 ok", texts[0], texts[0]]
    rows = [*enumerate(texts), (None, "null id"), (0, texts[0])]
    got = token_counts.count_tokens(clashing(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    want = collections.Counter((i, len((t or "").encode()), library(t), library(t) > 1024) for i, t in rows)
    assert collections.Counter(map(tuple, got)) == want


def test_token_counts_of_nothing(spark):
    assert token_counts.count_tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert [tuple(r) for r in token_counts.count_tokens(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()] == [(1, 0, 0, False)]


# --- very long texts -----------------------------------------------------------

LONG = "word" * 30_000 + " " + "ab cd\n" * 20_000 + "é日 x " * 500


def test_very_long_texts(spark, library):
    rows = [(1, LONG, "en"), (1, LONG, "en"), (2, "ab cd ef", "en"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {tuple(r) for r in collocations.collocations(docs).collect()} == brute_collocations([(t, lang) for _, t, lang in rows])
    n = library(LONG)
    want = [(1, len(LONG.encode()), n, True)] * 2 + [(2, 8, library("ab cd ef"), False), (None, 0, 0, False)]
    assert sorted(map(tuple, token_counts.count_tokens(docs).collect()), key=repr) == sorted(want, key=repr)
    talk = [(7, 0, "user", LONG + "."), (7, 1, "assistant", LONG + "."), (7, 2, "user", LONG + "."), (7, 3, "assistant", "Yes. " + LONG + "!")]
    table = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    assert {r[0]: tuple(r)[1:] for r in conversations.repair(table).collect()} == brute_repair(talk)
