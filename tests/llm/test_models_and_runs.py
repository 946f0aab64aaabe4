"""Language model, periodic runs and whitening against brute force, and on awkward rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import make_docs

from tidemark.llm import kneser_ney, periodic_runs, queries, whitening

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def crc(key):
    return zlib.crc32(str(key).encode())


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


# --- language model ---

def tokens_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")] + ["</s>"]


class PlainModel:
    """Modified Kneser-Ney in dictionaries."""

    def __init__(self, texts, order):
        self.order, self.raw = order, collections.Counter()
        counts = [collections.Counter() for _ in range(order + 1)]
        for text in texts:
            words = tokens_of(text)
            self.raw.update(words)
            padded = ["<s>"] * (order - 1) + words
            counts[order].update(tuple(padded[i : i + order]) for i in range(len(words)))
        for k in range(order, 1, -1):
            for gram, c in counts[k].items():
                counts[k - 1][gram[1:]] += c if gram[1] == "<s>" else 1
        self.counts, self.contexts, self.steps = counts, [None], [None]
        for k in range(1, order + 1):
            of = collections.Counter(counts[k].values())
            self.steps.append(kneser_ney.discounts(of[1], of[2], of[3], of[4]))
            groups = collections.defaultdict(list)
            for gram, c in counts[k].items():
                groups[gram[:-1]].append(c)
            steps = (0, *self.steps[k])
            self.contexts.append({g: (sum(own), sum(steps[min(x, 3)] for x in own)) for g, own in groups.items()})

    def probability(self, gram):
        if not gram:
            return 1 / (len(self.raw) + 1)
        k, lower = len(gram), self.probability(gram[1:])
        if gram[:-1] not in self.contexts[k]:
            return lower
        (total, taken), c = self.contexts[k][gram[:-1]], self.counts[k].get(gram, 0)
        return (c - (0, *self.steps[k])[min(c, 3)] + taken * lower) / total

    def score(self, text):
        words = tokens_of(text)
        padded = ["<s>"] * (self.order - 1) + words
        return sum(math.log10(self.probability(tuple(padded[i : i + self.order]))) for i in range(len(words)))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_language_model_equals_plain_kneser_ney(spark, monkeypatch, order):
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 20_000)  # many shards
    rows = documents()[:60]
    docs = make_docs(spark, [t for _, t in rows])
    model = kneser_ney.train(docs.where("doc_id % 3 <> 0"), order=order)
    plain = PlainModel([t for i, (_, t) in enumerate(rows) if i % 3], order)
    assert model.shards > 3 and model.words == len(plain.raw) and model.tokens == sum(plain.raw.values())
    assert np.array(model.discounts) == pytest.approx(np.array(plain.steps[1:]))
    for r in kneser_ney.score(docs, model).collect():
        words = tokens_of(r["text"])
        assert r["n_tokens"] == len(words) and r["n_known"] == sum(w in plain.raw for w in words)
        assert r["lm_score"] == pytest.approx(plain.score(r["text"]), rel=1e-9)
        assert r["perplexity"] == pytest.approx(10 ** (-r["lm_score"] / len(words)))


def test_probabilities_after_a_context_sum_to_one(spark):
    docs = make_docs(spark, ["a b a b c", "b a c a", None, "c c c a b"])
    model = kneser_ney.train(docs, order=2)
    every = np.arange(model.words + 2)
    every = every[every != model.words]  # the begin mark is never predicted; the last number stands for unseen words
    _, left = kneser_ney._vocabulary_fields(model, every)
    for context in [*range(model.words + 1)]:
        p = kneser_ney.token_probabilities(model, [np.full(len(every), context), every], left)
        assert p.sum() == pytest.approx(1) and (p > 0).all()


def test_language_model_query(spark):
    rows = documents()
    got = {r["doc_id"]: r for r in queries.op11_language_model(spark, SF).collect()}
    plain = PlainModel([t for i, t in rows if crc(i) % 7 != 2], 2)
    total = sum(plain.raw.values())
    assert set(got) == {i for i, _ in rows}
    for i, text in rows:
        words, r = tokens_of(text), got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (crc(i) % 7 == 2, len(words), sum(w in plain.raw for w in words), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((plain.raw[w] + 1) / (total + len(plain.raw) + 1)) for w in words), rel=1e-9)
        assert r["score"] == pytest.approx(plain.score(text), rel=1e-9)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_query_scores_trigrams(spark, tmp_path):
    rows = [(i, " ".join(random.Random(i % 40).choices("abcdef", k=3 + i % 9)) if i % 11 else None) for i in range(120)]
    make_docs(spark, [t for _, t in rows]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["score"] for r in queries.op11_language_model(spark, str(tmp_path)).collect()}
    of = {order: PlainModel([t for i, t in rows if crc(i) % 7 != 2], order) for order in (2, 3)}
    assert got == pytest.approx({i: of[3].score(t) for i, t in rows}, rel=1e-9)
    assert sum(abs(got[i] - of[2].score(t)) > 0.01 for i, t in rows) > 60


def test_language_model_on_awkward_rows(spark, edge_docs):
    odd = edge_docs.withColumnsRenamed({"lang": "lm_score", "source": "shard"}).selectExpr("*", "'x' AS blob", "1 AS n_tokens")
    model = kneser_ney.train(odd, order=2)
    out = kneser_ney.score(odd, model)
    assert {"shard", "blob"} < set(out.columns)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[0]["n_tokens"] == rows[1]["n_tokens"] == rows[2]["n_tokens"] == 1 and rows[7]["n_tokens"] == 80_001
    assert rows[4]["lm_score"] == rows[6]["lm_score"]  # capitals do not count
    plain = PlainModel([r["text"] for r in edge_docs.collect()], 2)
    assert all(r["lm_score"] == pytest.approx(plain.score(r["text"]), rel=1e-9) for r in rows.values())
    none = kneser_ney.train(edge_docs.limit(0), order=2)
    assert none.tokens == none.words == 0
    assert all(r["lm_score"] == 0 and r["n_known"] == 0 for r in kneser_ney.score(edge_docs, none).collect())
    assert kneser_ney.score(edge_docs.limit(0), model).count() == 0
    twice = kneser_ney.train(edge_docs.union(edge_docs), order=2)
    assert twice.tokens == 2 * model.tokens and twice.words == model.words
    with pytest.raises(ValueError):
        kneser_ney.train(edge_docs, order=1)


def test_blocks_of_texts_do_not_change_scores(spark, edge_docs, monkeypatch):
    model = kneser_ney.train(edge_docs, order=3)
    whole = {r["doc_id"]: r["lm_score"] for r in kneser_ney.score(edge_docs, model).collect()}
    block = edge_docs.select("text").toArrow().combine_chunks().to_batches()
    monkeypatch.setattr(kneser_ney, "BLOCK_TOKENS", 777)
    monkeypatch.setattr(kneser_ney, "BLOCK_BYTES", 50)
    seen = []
    for batch, tokens, ends in kneser_ney._texts(iter(block), 0):
        numbers = kneser_ney._word_numbers(model, tokens)
        logs = [np.log10(kneser_ney.token_probabilities(model, g, kneser_ney._vocabulary_fields(model, g[-1])[1])) for _, g in kneser_ney._windows(numbers, ends, 3, model.words)]
        seen += np.add.reduceat(np.concatenate(logs), ends[:-1]).tolist()
    assert seen == pytest.approx([whole[i] for i in range(len(seen))])


# --- periodic runs ---

def plain_lyndon(s):
    return [max(n for n in range(1, len(s) - i + 1) if all(s[i : i + n] < s[i + k : i + n] for k in range(1, n))) for i in range(len(s))]


def plain_runs(s, least):
    out = set()
    for q in range(1, len(s) // 2 + 1):
        same = [a == b for a, b in zip(s, s[q:], strict=False)]
        at = 0
        for equal, group in itertools.groupby(same):
            size = len(list(group))
            if equal and size + q >= max(least, 2 * q):
                part = s[at : at + size + q]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.add((at, size + q, q))
            at += size
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_lyndon_words():
    rng = random.Random(1)
    for _ in range(1500):
        s = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randrange(14))]
        s = [sorted(set(s)).index(x) for x in s]
        assert periodic_runs.lyndon_lengths(s) == plain_lyndon(s)


def test_runs_equal_brute_force():
    rng = random.Random(2)
    for _ in range(1500):
        docs = []
        for _ in range(rng.randrange(1, 4)):
            s = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(60))]
            if s and rng.random() < 0.5:
                at = rng.randrange(len(s))
                s[at:at] = s[: rng.randrange(1, 8)] * rng.randrange(2, 8)
            docs.append(s)
        least = rng.choice([2, 4, 7, 12])
        offsets = np.cumsum([0] + [len(d) for d in docs])
        ids = np.array([x + 100 * k for k, d in enumerate(docs) for x in d], np.int64)
        want = [(a + offsets[k], n, q) for k, d in enumerate(docs) for a, n, q in plain_runs(d, least)]
        assert [tuple(r) for r in periodic_runs.find_runs(ids, offsets, least).tolist()] == want


def plain_digest(key, text):
    words, h = WORD.findall(text or ""), crc(key)
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 12)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    longest = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *longest, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_periodic_runs_query(spark):
    rows = [(i, t) for i, t in documents() if len(t or "") < 4000 or crc(i) % 10 == 0 and len(t) < 9000]
    assert len(rows) > 150 and any(crc(i) % 10 == 0 for i, _ in rows)
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, SF).collect()}
    for i, text in rows:
        assert got[i] == plain_digest(i, text)
    assert sum(n[0] > 0 for n in got.values()) > 15


def test_periodic_runs_on_awkward_rows(spark, edge_docs):
    odd = edge_docs.withColumnsRenamed({"lang": "runs", "source": "collapsed"}).selectExpr("*", "'x' AS start")
    out = periodic_runs.periodic_runs(odd)
    assert out.columns == ["doc_id", "text", "n_chars", "start", "n_words", "runs", "collapsed"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(rows[i]["runs"] == [] and rows[i]["collapsed"] == "" for i in (0, 1, 2))
    assert [tuple(r) for r in rows[9]["runs"]] == [(0, 60, 12)] and rows[9]["collapsed"] == rows[4]["text"]
    assert rows[7]["n_words"] == 80_000 and rows[7]["runs"] == []
    assert periodic_runs.periodic_runs(odd.limit(0)).count() == 0
    keyless = make_docs(spark, ["a " * 30]).selectExpr("CAST(NULL AS long) AS doc_id", "text")
    both = periodic_runs.periodic_runs(keyless.union(keyless), rewrite=queries.repeated_from).collect()
    assert [(r["doc_id"], r["collapsed"]) for r in both] == [(None, "a")] * 2
    long = make_docs(spark, ["x y " * 60_000 + "z", " ".join(["q"] * 50_000)])
    assert [[tuple(r) for r in row["runs"]] for row in periodic_runs.periodic_runs(long).orderBy("doc_id").collect()] == [[(0, 120_000, 2)], [(0, 50_000, 1)]]


# --- whitening ---

def plain_fit(vectors):
    x = np.unique(np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]), axis=0)
    values, axes = np.linalg.eigh(np.cov(x.T.astype(float), bias=True).reshape(x.shape[1], x.shape[1]))
    return x, values[::-1], axes[:, ::-1].T


def vector_table(spark, vectors):
    return spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")


def test_whitening_query(spark):
    rows = [(i, v) for i, v in duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall() if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x, values, axes = plain_fit([v for _, v in rows])
    n, sums = len(x), [int(s) for s in x.sum(0)]
    got = collections.defaultdict(list)
    for r in queries.op13_whitening(spark, SF).collect():
        got[r["vec_id"]].append(r)
    assert len(got) == len({i for i, _ in rows})
    signs = None
    for i, v in rows:
        own = sorted(got[i], key=lambda r: r["component"])
        mine = [math.floor(64 * c) + 1_000_000 for c in v]
        want = axes[:16] @ (np.array(mine) - x.mean(0)) / np.sqrt(values[:16])
        signs = np.sign(want * [r["whitened"] for r in own]) if signs is None else signs
        assert [r["component"] for r in own] == list(range(1, 17)) and {r["n"] for r in own} == {n}
        assert {r["deviation"] for r in own} == {sum((n * a - s) ** 2 for a, s in zip(mine, sums, strict=True))}
        assert [r["whitened"] for r in own] == pytest.approx(list(want * signs), abs=1e-7)
        assert [r["explained"] for r in own] == pytest.approx(list(values[:16] / values.sum()))
        assert own[0]["identity_error"] < 1e-9


def test_characteristic_polynomial_and_roots(spark):
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 9):
        a = rng.integers(-50, 50, (d, max(1, d - 2)))
        m = (a @ a.T).tolist()  # singular for d > 2
        poly = whitening.characteristic_polynomial(spark, m)
        assert poly[-1] == 1 and poly[-2] == -sum(m[i][i] for i in range(d))
        assert np.poly(np.array(m, float)) == pytest.approx([float(c) for c in reversed(poly)], rel=1e-6, abs=1e-3 * abs(poly[-2]) ** d)
        roots, vectors = whitening.principal_components(spark, m, d)
        assert len(roots) == max(1, d - 2) if any(map(any, m)) else not roots
        for root, v in zip(roots, vectors, strict=True):
            assert np.array(m, float) @ v == pytest.approx(float(root) * v, abs=1e-9 * float(roots[0]))


def test_equal_and_nearly_equal_eigenvalues(spark):
    m = [[7, 0, 0, 0], [0, 7, 0, 0], [0, 0, 7, 0], [0, 0, 0, 2]]
    roots, vectors = whitening.principal_components(spark, m, 3)
    assert roots == [7, 7, 7] and vectors @ vectors.T == pytest.approx(np.eye(3), abs=1e-14)
    big = 10**40
    roots, vectors = whitening.principal_components(spark, [[big + 1, 0, 0], [0, big, 0], [0, 0, 5]], 3)
    assert [round(r) for r in roots] == [big + 1, big, 5]
    assert np.abs(vectors) == pytest.approx(np.eye(3), abs=1e-14)


def test_whitening_on_awkward_rows(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(0, 3, (60, 4)).tolist()
    odd = [None, [1.0, None, 2.0, 3.0], [math.nan, 0.0, 0.0, 0.0], [math.inf, 0.0, 0.0, 0.0], [1e300, 0.0, 0.0, 0.0], [], [1.0, 2.0], *good[:20]]
    df = vector_table(spark, good + odd).selectExpr("CASE WHEN vec_id = 3 THEN NULL ELSE vec_id END AS vec_id", "embedding", "'x' AS component", "1 AS y", "2 AS n")
    model = whitening.fit_whitening(df, components=16)
    x, values, _ = plain_fit(good)
    assert (model.n, model.dimension, len(model.roots)) == (len(x), 4, 4)
    assert model.eigenvalues == pytest.approx(values.tolist()) and model.identity_error < 1e-9
    rows = whitening.whiten(df, model).collect()
    assert len(rows) == 80 * 4 and sum(r["vec_id"] is None for r in rows) == 4
    assert whitening.fit_whitening(df.limit(0)) is None and whitening.whiten(df, None).count() == 0
    assert whitening.fit_whitening(vector_table(spark, [good[0]] * 9)) is None
    flat = whitening.fit_whitening(vector_table(spark, [[1.0, float(k), 5.0] for k in range(9)]))
    assert len(flat.roots) == 1 and np.abs(flat.components[0]) == pytest.approx([0, 1, 0])


def test_exact_sums_of_large_entries():
    y = np.array([[2**61, -(2**61) + 5, 3], [2**40 + 1, -7, 2**27], [-1, 1, 2**26]], np.int64)
    want = [[sum(int(r[i]) * int(r[j]) for r in y) for j in range(3)] for i in range(3)]
    assert whitening.exact_gram(y).tolist() == want
    sums = tuple(int(sum(map(int, y[:, j]))) for j in range(3))
    for rows in (y, y[1:, 1:2] % 1000 - 500):
        own = sums[: rows.shape[1]]
        model = whitening.Whitening(3, rows.shape[1], own, 1, (), np.zeros((0, rows.shape[1])), 0.0)
        assert model.deviations(rows) == [sum((3 * int(a) - s) ** 2 for a, s in zip(r, own, strict=True)) for r in rows]
    for own in ((-5, 2**70), (-(2**70), 0), (0, -1)):
        model = whitening.Whitening(10**9, 2, own, 1, (), np.zeros((0, 2)), 0.0)
        assert model.deviations(np.array([[3, -4], [0, 9]])) == [sum((10**9 * a - s) ** 2 for a, s in zip(r, own, strict=True)) for r in [(3, -4), (0, 9)]]


def test_vectors_of_floats_keep_their_values():
    column = pa.array([[0.5, -0.5], None, [1.0 / 128, 2.0]], pa.list_(pa.float32()))
    rows, at, entries = whitening._whole_numbers(column)
    assert (rows.tolist(), at.tolist(), entries.tolist()) == ([0, 2], [0, 2, 4], [32, -32, 0, 128])
