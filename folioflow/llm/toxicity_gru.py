"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A token enters as the sum of a word embedding and the embeddings of its
character 3- to 5-grams (hashed), so an unseen form of a known stem still
counts. Two recurrent layers read a window forwards and backwards, attention
pools their states, and a logistic output scores the window. All windows of
WINDOW tokens at every half window are scored, over the whole text; a text's
score is that of its worst window.

Training is numpy in one task, on a bounded sample of labelled rows: at most
SAMPLE_ROWS rows of each label, lowest hashes first, of texts up to
SAMPLE_CHARS code points; rows whose crc32(doc_id) is divisible by HOLD_OUT are
never read. Labels are for whole texts, so the window that speaks for a toxic
text is chosen anew in each round (at first by how much likelier its words are
in toxic texts), against random and against the worst windows of other texts.

Scoring keeps each distinct chunk of text once a worker, as its row of input
projections, so a token costs a lookup and its share of a few small products.

Edge cases: a null text is the empty text, whose only window is empty and is
scored like any other; null labels are not used, the larger of two labels of
one id is; without both labels in the sample every score is 0 (nothing is known
to be toxic); repeated rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DOCUMENT, pick, releasing, resident, slices, stored

WINDOW, HALF = 32, 16
HOLD_OUT, SAMPLE_ROWS, SAMPLE_CHARS = 5, 1200, 10_000
#: Sizes: embedding, state of a direction, attention; buckets of words and of character n-grams.
EMBED, STATE, ATTEND = 12, 8, 8
WORDS, GRAMS = 1 << 14, 1 << 16
ROUNDS, EPOCHS, BATCH, RATE = 3, 4, 128, 0.02
#: Chunks that a worker keeps before it starts anew (about 400 MB), and where it serves other operators too.
CACHE_WORDS, SHARED_WORDS = 500_000, 200_000
#: Windows scored together.
TOGETHER = 2048

RESULT = "doc_id long, held_out boolean, score double, predicted int"
_OTHER = re.compile(r"[\W_]+")

Params = dict[str, np.ndarray]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids of all words' features in a row, and where each word's begin (one more at the end).

    A word's features are its own bucket and its character n-grams with a mark
    at both ends; an empty word has none.
    """
    marked = [f"\x02{w}\x03" if w else "" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, marked), np.int64, len(words)))
    ids = [np.fromiter((zlib.crc32(w.encode()) % WORDS for w in words if w), np.int64)]
    owners = [np.array([i for i, w in enumerate(words) if w], np.int64)]
    for n in (3, 4, 5):
        if len(codes) < n:
            continue
        value = np.full(len(codes) - n + 1, n, np.uint64)
        for k in range(n):
            value = value * np.uint64(0x100000001B3) + codes[k : len(codes) - n + 1 + k]
        inside = owner[: len(value)] == owner[n - 1 :]
        value = (value[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        ids.append(WORDS + (value % np.uint64(GRAMS)).astype(np.int64))
        owners.append(owner[: len(inside)][inside])
    owner, ids = np.concatenate(owners), np.concatenate(ids)
    order = np.argsort(owner, kind="stable")
    return ids[order], np.searchsorted(owner[order], np.arange(len(words) + 1))


def all_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``features`` of many words, some at a time, in half the bytes."""
    ids, sizes = [], []
    for i in range(0, len(words), 20_000):
        part, begins = features(words[i : i + 20_000])
        ids.append(part.astype(np.int32))
        sizes.append(np.diff(begins))
    return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def embed(table: np.ndarray, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of feature embeddings by word, over the root of their number."""
    total = np.zeros((len(ids) + 1, table.shape[1]))
    np.cumsum(table[ids], axis=0, out=total[1:])
    sums = total[begins[1:]] - total[begins[:-1]]
    return (sums / np.sqrt(np.maximum(1, np.diff(begins)))[:, None]).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_params(seed: int = 7) -> Params:
    r = np.random.default_rng(seed)
    f = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
    out = {"E": f(WORDS + GRAMS, EMBED, scale=0.05)}
    for d in "fb":
        out |= {f"W{d}": f(EMBED, 3 * STATE, scale=EMBED**-0.5), f"c{d}": np.zeros(3 * STATE, np.float32), f"U{d}": f(STATE, 3 * STATE, scale=STATE**-0.5)}
    return out | {"A": f(2 * STATE, ATTEND, scale=0.3), "a": np.zeros(ATTEND, np.float32), "v": f(ATTEND, scale=0.5), "w": f(2 * STATE, scale=0.5), "b": np.zeros(1, np.float32)}


def run_direction(x: np.ndarray, mask: np.ndarray, u: np.ndarray, backwards: bool, keep: list | None) -> np.ndarray:
    """States (T, B, STATE) of one direction over projected inputs (T, B, 3 * STATE)."""
    steps, size, _ = x.shape
    h = np.zeros((size, STATE), np.float32)
    out = np.empty((steps, size, STATE), np.float32)
    for t in reversed(range(steps)) if backwards else range(steps):
        rec = h @ u
        gates = sigmoid(x[t, :, : 2 * STATE] + rec[:, : 2 * STATE])
        z, r = gates[:, :STATE], gates[:, STATE:]
        n = np.tanh(x[t, :, 2 * STATE :] + r * rec[:, 2 * STATE :])
        new = n + z * (h - n)
        m = mask[t][:, None]
        if keep is not None:
            keep.append((t, h, z, r, n, rec[:, 2 * STATE :], m))
        h = np.where(m, new, h)
        out[t] = h
    return out


def pool(params: Params, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
    """Logits (B,), attention weights (T, B), hidden attention and pooled states."""
    hidden = np.tanh(states @ params["A"] + params["a"])
    energy = np.where(mask, hidden @ params["v"], np.float32(-1e9))
    weight = np.exp(energy - energy.max(0))
    weight = weight * mask
    weight /= np.maximum(weight.sum(0), 1e-9)
    pooled = np.einsum("tb,tbk->bk", weight, states)
    return pooled @ params["w"] + params["b"], weight, hidden, pooled


def loss_and_gradients(params: Params, vectors: np.ndarray, index: np.ndarray, label: np.ndarray) -> tuple[float, Params, np.ndarray]:
    """Mean logistic loss, the gradients of all but E, and that of ``vectors``.

    vectors: embeddings of the batch's words, row 0 the padding; index: (B, T).
    """
    index = index.T
    mask = index > 0
    x = {d: vectors[index] @ params[f"W{d}"] + params[f"c{d}"] for d in "fb"}
    kept: dict[str, list] = {"f": [], "b": []}
    states = np.concatenate([run_direction(x[d], mask, params[f"U{d}"], d == "b", kept[d]) for d in "fb"], 2)
    logit, weight, hidden, pooled = pool(params, states, mask)
    p = sigmoid(logit)
    loss = float(np.mean(np.logaddexp(0, logit) - label * logit))
    g: Params = {}
    d_logit = ((p - label) / len(label)).astype(np.float32)
    g["w"], g["b"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
    d_pooled = d_logit[:, None] * params["w"]
    d_states = weight[:, :, None] * d_pooled[None]
    d_weight = np.einsum("bk,tbk->tb", d_pooled, states)
    d_energy = weight * (d_weight - (weight * d_weight).sum(0))
    g["v"] = np.einsum("tb,tbk->k", d_energy, hidden)
    d_hidden = d_energy[:, :, None] * params["v"] * (1 - hidden**2)
    g["A"] = np.einsum("tbi,tbj->ij", states, d_hidden)
    g["a"] = d_hidden.sum((0, 1))
    d_states += d_hidden @ params["A"].T
    d_vectors = np.zeros_like(vectors)
    for k, d in enumerate("fb"):
        u = params[f"U{d}"]
        g[f"U{d}"] = np.zeros_like(u)
        d_x = np.zeros_like(x[d])
        d_h = np.zeros((index.shape[1], STATE), np.float32)
        for t, h, z, r, n, rec_n, m in reversed(kept[d]):
            d_h = d_h + d_states[t, :, k * STATE : (k + 1) * STATE]
            new = np.where(m, d_h, 0)
            back = np.where(m, 0, d_h) + new * z
            pre_n = new * (1 - z) * (1 - n**2)
            pre_z = new * (h - n) * z * (1 - z)
            pre_r = pre_n * rec_n * r * (1 - r)
            d_x[t] = np.concatenate([pre_z, pre_r, pre_n], 1)
            rec = np.concatenate([pre_z, pre_r, pre_n * r], 1)
            g[f"U{d}"] += h.T @ rec
            d_h = back + rec @ u.T
        flat = d_x.reshape(-1, 3 * STATE)
        g[f"W{d}"] = vectors[index].reshape(-1, EMBED).T @ flat
        g[f"c{d}"] = flat.sum(0)
        np.add.at(d_vectors, index.reshape(-1), flat @ params[f"W{d}"].T)
    d_vectors[0] = 0
    return loss, g, d_vectors


class Adam:
    """Adam, step sizes by running moments."""

    def __init__(self, params: Params, rate: float) -> None:
        self.params, self.rate, self.step = params, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in params.items()}
        self.second = {k: np.zeros_like(v) for k, v in params.items()}

    def apply(self, gradients: Params, rows: np.ndarray, d_rows: np.ndarray) -> None:
        """gradients: of all but E, which moves only in ``rows``."""
        self.step += 1
        rate = self.rate * (1 - 0.999**self.step) ** 0.5 / (1 - 0.9**self.step)
        for k, g in [*gradients.items(), ("E", d_rows)]:
            at = rows if k == "E" else ...
            first = self.first[k][at] + 0.1 * (g - self.first[k][at])
            second = self.second[k][at] + 0.001 * (g * g - self.second[k][at])
            self.first[k][at], self.second[k][at] = first, second
            self.params[k][at] -= rate * first / (np.sqrt(second) + 1e-8)


def normal(chunk: str) -> str:
    """A chunk's letters and digits, in lower case."""
    return _OTHER.sub("", chunk.lower())


def windows_of(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All windows (n, WINDOW) of all texts, 0 for padding, and the text of each."""
    counts = np.array([max(2, -(-len(x) // HALF)) for x in tokens])
    halves = np.zeros((int(counts.sum()), HALF), np.int32)
    begins = np.concatenate([[0], np.cumsum(counts)])
    flat = halves.reshape(-1)
    for x, at in zip(tokens, begins.tolist()):
        flat[at * HALF : at * HALF + len(x)] = x
    owner = np.repeat(np.arange(len(tokens)), counts)
    first = np.flatnonzero(owner[:-1] == owner[1:])
    return np.concatenate([halves[first], halves[first + 1]], 1), owner[first]


class Scorer:
    """Scores texts with fixed parameters; keeps projections of the chunks it has met."""

    def __init__(self, params: Params, limit: int = CACHE_WORDS) -> None:
        self.params, self.limit = params, limit
        self.ids: dict[str, int] = {}
        self.rows = {d: np.zeros((limit + 1, 3 * STATE), np.float32) for d in "fb"}

    def _learn(self, chunks: list[str]) -> None:
        if len(self.ids) + len(chunks) > self.limit:
            self.ids.clear()
        need = len(self.ids) + 1 + len(chunks)
        for d, rows in self.rows.items():
            if need > len(rows):
                self.rows[d] = np.concatenate([rows, np.zeros((max(need, 2 * len(rows)) - len(rows), 3 * STATE), np.float32)])
        for i in range(0, len(chunks), 20_000):
            part = chunks[i : i + 20_000]
            vectors = embed(self.params["E"], *features([normal(c) for c in part]))
            at = len(self.ids) + 1
            for d, rows in self.rows.items():
                rows[at : at + len(part)] = vectors @ self.params[f"W{d}"] + self.params[f"c{d}"]
            self.ids.update(zip(part, range(at, at + len(part))))

    def tokens(self, texts: list[str]) -> list[np.ndarray]:
        chunked = [x.split() for x in texts]
        every = set().union(*chunked)
        fresh = [c for c in every if c not in self.ids]
        if len(self.ids) + len(fresh) > self.limit:
            self.ids.clear()
            fresh = list(every)
        self._learn(fresh)
        get = self.ids.__getitem__
        return [np.fromiter(map(get, x), np.int32, len(x)) for x in chunked]

    def window_logits(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty(len(windows), np.float32)
        for i in range(0, len(windows), TOGETHER):
            index = np.ascontiguousarray(windows[i : i + TOGETHER].T)
            mask = index > 0
            states = np.concatenate([run_direction(self.rows[d][index], mask, self.params[f"U{d}"], d == "b", None) for d in "fb"], 2)
            out[i : i + TOGETHER] = pool(self.params, states, mask)[0]
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        """The largest window probability of each text."""
        windows, owner = windows_of(self.tokens(texts))
        worst = np.full(len(texts), -np.inf, np.float32)
        np.maximum.at(worst, owner, self.window_logits(windows))
        return np.round(sigmoid(worst.astype(np.float64)), 6)


def train(texts: list[str], labels: list[int], seed: int = 7) -> Params | None:
    """Parameters fitted to whole-text labels; None unless both labels occur."""
    label = np.array(labels, np.float32)
    if len(texts) == 0 or label.min() == label.max():
        return None
    random = np.random.default_rng(seed)
    number: dict[str, int] = {"": 1}  # of words; 0 is the padding
    known: dict[str, int] = {}  # of chunks as they stand in the texts
    tokens = []
    for text in texts:
        chunks = text.split()
        for c in chunks:
            if c not in known:
                known[c] = number.setdefault(normal(c), len(number) + 1)
        tokens.append(np.fromiter(map(known.__getitem__, chunks), np.int32, len(chunks)))
    del known
    feature_ids, begins = all_features(["", *number])
    windows, owner = windows_of(tokens)
    toxic = label[owner] > 0
    # How much likelier each feature is in toxic texts gives the first choice of windows.
    seen = np.zeros((2, WORDS + GRAMS))
    for x, y in zip(tokens, labels):
        spans = [feature_ids[begins[i] : begins[i + 1]] for i in np.unique(x).tolist()]
        if spans:
            seen[y, np.unique(np.concatenate(spans))] += 1
    no, yes = seen
    odds = np.where(yes >= 3, np.log((yes + 0.5) / (no + 0.5) * ((1 - label).sum() + 1) / (label.sum() + 1)), 0.0)
    odds *= yes / (yes + 5)
    best = np.array([odds[feature_ids[begins[i] : begins[i + 1]]].max(initial=0) for i in range(len(begins) - 1)])
    value = best[windows].max(1)
    params = new_params(seed)
    optimiser = Adam(params, RATE)
    positives = int(label.sum())
    for round_ in range(ROUNDS):
        order = np.lexsort((-value, owner))
        top = order[np.flatnonzero(np.diff(owner[order], prepend=-1))]  # the worst window of each text
        chosen = top[toxic[top]]
        clean = np.flatnonzero(~toxic)
        easy = random.choice(clean, min(len(clean), positives + 500), replace=False)
        batch_rows = np.unique(np.concatenate([chosen, easy, top[~toxic[top]]]))
        for _ in range(EPOCHS):
            random.shuffle(batch_rows)
            for i in range(0, len(batch_rows), BATCH):
                rows = batch_rows[i : i + BATCH]
                used, index = np.unique(windows[rows], return_inverse=True)
                if used[0] != 0:
                    used, index = np.concatenate([[0], used]), index + 1
                ids = np.concatenate([feature_ids[begins[w] : begins[w + 1]] for w in used.tolist()])
                sizes = begins[used + 1] - begins[used]
                starts = np.concatenate([[0], np.cumsum(sizes)])
                vectors = embed(params["E"], ids, starts)
                _, g, d_vectors = loss_and_gradients(params, vectors, index.reshape(len(rows), WINDOW), toxic[rows].astype(np.float32))
                share = d_vectors / np.sqrt(np.maximum(1, sizes))[:, None]
                order = np.argsort(ids, kind="stable")
                touched, first = np.unique(ids[order], return_index=True)
                optimiser.apply(g, touched, np.add.reduceat(np.repeat(share, sizes, axis=0)[order], first, axis=0).astype(np.float32))
        optimiser.rate *= 0.6
        value = _logits(params, feature_ids, begins, windows)
    # The output is shifted so that one half lies where the whole-text scores part best.
    worst = np.full(len(texts), -np.inf)
    np.maximum.at(worst, owner, value)
    params["b"] -= np.float32(_cut(worst, label))
    return params


def _logits(params: Params, feature_ids: np.ndarray, begins: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Window logits with the projections of all words, worked out some at a time."""
    scorer = Scorer(params)
    scorer.rows = {d: np.zeros((len(begins) - 1, 3 * STATE), np.float32) for d in "fb"}
    for i in range(0, len(begins) - 1, 20_000):
        at = begins[i : i + 20_001]
        vectors = embed(params["E"], feature_ids[at[0] : at[-1]], at - at[0])
        for d, rows in scorer.rows.items():
            rows[i : i + len(vectors)] = vectors @ params[f"W{d}"] + params[f"c{d}"]
    return scorer.window_logits(windows)


def _cut(score: np.ndarray, label: np.ndarray) -> float:
    """The middle of the widest stretch of thresholds with the fewest errors."""
    order = np.argsort(score, kind="stable")
    s, y = score[order], label[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + (1 - y).sum() - np.concatenate([[0], np.cumsum(1 - y)])
    edges = np.concatenate([[s[0] - 2], s, [s[-1] + 2]])
    gaps = np.where(errors == errors.min(), np.diff(edges), -1)
    k = int(gaps.argmax())
    return float((edges[k] + edges[k + 1]) / 2)


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the rows to train on: at most SAMPLE_ROWS of each label, none held out.

    Labels meet the ids of documents first, so that those of absent or too long
    ones take no place; of rows that repeat an id, the least text stands.
    """
    known = pick(labels, doc_id="long", toxic="int").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % HOLD_OUT != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = pick(docs, doc_id="long", text="string").where(F.length("text") <= SAMPLE_CHARS)
    present = stored(known.join(texts.select("doc_id"), "doc_id", "left_semi"), "toxicity-labels")
    chosen = [present.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS) for value in (0, 1)]
    # Two fixed limits bound the broadcast side: at most 2 * SAMPLE_ROWS ids.
    found = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> Params | None:
    """Parameters trained in one task, on the bounded sample; the driver gets them alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in releasing(batches, True):
            texts += batch.column("text").to_pylist()
            toxic += batch.column("toxic").to_pylist()
        order = sorted(range(len(texts)), key=lambda i: (toxic[i], zlib.crc32(texts[i].encode()), texts[i]))
        params = train([texts[i] for i in order], [toxic[i] for i in order])
        names = sorted(params or {})
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([list(params[k].shape) for k in names], pa.list_(pa.int32())), pa.array([params[k].tobytes() for k in names], pa.binary())],
            names=["name", "shape", "data"],
        )

    found = sample(docs, labels).coalesce(1).mapInArrow(run, "name string, shape array<int>, data binary").collect()
    return {r["name"]: np.frombuffer(r["data"], np.float32).reshape(r["shape"]) for r in found} or None


def _scorer(token: int, params: Params, limit: int = CACHE_WORDS) -> Scorer:
    """One scorer a Python worker, kept across tasks."""
    return resident(("toxicity", token, limit), lambda: Scorer(params, limit))


def score(docs: DataFrame, params: Params | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document (``RESULT``)."""
    held_out = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % HOLD_OUT == 0).alias("held_out")
    rows = pick(docs, doc_id="long", text="string").select("doc_id", "text", held_out)
    if params is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(params)
    token = zlib.crc32(params["w"].tobytes() + params["Uf"].tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(token, shared.value)
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                found = scorer.score([x or "" for x in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, RESULT)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled sample and score every document."""
    return score(docs, fit(docs, labels))


def clean_only(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` whose score is below one half."""
    rows = pick(docs, **DOCUMENT)
    params = fit(rows, labels)
    if params is None:
        return rows
    shared = docs.sparkSession.sparkContext.broadcast(params)
    token = zlib.crc32(params["w"].tobytes() + params["Uf"].tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(token, shared.value, SHARED_WORDS)
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                yield batch.filter(pa.array(scorer.score([x or "" for x in batch.column("text").to_pylist()]) < 0.5))

    return rows.mapInArrow(lambda batches: releasing(run(batches), True), rows.schema)
