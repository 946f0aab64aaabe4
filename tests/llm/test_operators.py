"""Each operator against brute force on the smallest tables, and on awkward rows."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import rows_of
from llm.conftest import make_docs
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, kernels, language_id, line_dedup, packing, quality_rules, queries, rule_ensemble, suffix_dedup, token_ids, toxicity, url_filters
from tidemark.llm.common import connected_components
from tidemark.llm.oracle import SQL

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def crc(key):
    return zlib.crc32(str(key).encode())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    result = con.execute(SQL[name])
    order = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(order)
    assert rows_of(df.select(*order)) == sorted(result.fetchall(), key=repr)


def test_word_hashes_follow_the_words():
    texts = ["Ab  ab\tc", "", "a" * 5000, "b c \x0bd"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    hashes, at, starts, ends = kernels.word_hashes(np.frombuffer(data, np.uint8), offsets)
    words = [data[a:b].decode().lower() for a, b in zip(starts, ends, strict=True)]
    assert words == [w.lower() for t in texts for w in WORD.findall(t)]
    assert at.tolist() == [0, 3, 3, 4, 6]
    assert hashes[0] == hashes[1] and len(set(hashes.tolist())) == len(set(words))


def test_blocks_do_not_change_word_hashes(monkeypatch):
    text = " ".join(f"w{i}" for i in range(3000)).encode()
    whole = kernels.word_hashes(np.frombuffer(text, np.uint8), np.array([0, 7000, len(text)]))
    monkeypatch.setattr(kernels, "BLOCK", 256)
    parts = kernels.word_hashes(np.frombuffer(text, np.uint8), np.array([0, 7000, len(text)]))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (20, 21), (21, 20), *((100, 101 + i) for i in range(50)), (150, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert {got[i] for i in (1, 2, 3, 100, 120, 150)} == {1} and {got[i] for i in (7, 8, 9)} == {7} and got[21] == 20 and 5 not in got


# 1
def test_language(spark, edge_docs):
    rows = {r["doc_id"]: r for r in queries.op1_language_id(spark, SF).collect()}
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    held = [d for d in rows if crc(d) % 4 == 2]
    assert all(rows[d]["held_out"] == (crc(d) % 4 == 2) for d in rows) and len(rows) == len(lang)
    assert sum(rows[d]["lang_pred"] == lang[d] for d in held) >= 0.9 * len(held)
    samples = (("aa", b"alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 3), ("bb", b"uno dos tres cuatro cinco seis siete ocho nueve diez " * 3))
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(edge_docs.withColumn("score", F.lit("clash")), samples).collect()}
    assert out[0] == out[1] == out[2] == ("und", 0.0) and out[4][0] == out[5][0] == out[6][0] == "aa"
    assert all(0 <= s <= 1 for _, s in out.values()) and len(out) == 12
    assert {r["lang_pred"] for r in language_id.identify(edge_docs, ()).collect()} == {"und"}
    assert language_id.learn_samples(edge_docs.where("false")) == ()


def test_phrases_are_greedy_longest_matches():
    samples = (("x", b"the cat sat on the mat "), ("y", b"dog runs off "))
    text = b"the dog sat off the cat mat runs"
    got = language_id.phrase_counts(np.frombuffer(text, np.uint8), np.array([0, len(text)]), samples)[0]
    for (_, sample), count in zip(samples, got, strict=True):
        at, phrases = 0, 0
        while at < len(text):
            size = 1
            while at + size < len(text) and text[at : at + size + 1] in sample:
                size += 1
            at, phrases = at + size, phrases + 1
        assert count == phrases


# 2
def test_lines(spark, edge_docs):
    base = "the quick brown fox jumps over the lazy dog and then walks home again slowly"
    near, other = base.replace("lazy", "lazi"), "completely different words stand here in this one line of text"
    docs = make_docs(spark, [f"{base}\n{other}", f"short\n{near}", f"{base.upper()}!\nshort", None, ""])
    out = {r["doc_id"]: (r["text"], r["n_lines_removed"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert out[0] == (f"{base}\n{other}", 0) and out[2] == ("short", 1) and out[3] == (None, 0) and out[4] == ("", 0)
    assert out[1] in ((f"short\n{near}", 0), ("short", 1))  # one letter may move the hash further than DISTANCE
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(edge_docs).collect()}
    assert out[5] == out[6] == out[9] == "" and out[0] is None and out[3] == "one" and len(out) == 12
    assert line_dedup.dedup_lines(docs.where("false")).count() == 0


def test_edit_distance_and_near_hashes(spark):
    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert line_dedup.edit_distance(a, b) == slow(a, b)
    seeds = [rng.getrandbits(64) for _ in range(60)]
    values = list(dict.fromkeys(seeds + [s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for s in seeds for _ in range(4)]))
    rows = [(v - (1 << 64) if v >> 63 else v, v % 1000) for v in values]
    got = {frozenset(r) for r in line_dedup.similar_hashes(spark.createDataFrame(rows, "sim long, grp long"), len(rows), True).collect()}
    want = {frozenset((a, b)) for (a, g), (b, h) in itertools.combinations(rows, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= line_dedup.DISTANCE and g != h}
    assert got == want and want


# 3
def test_packing(spark, edge_docs):
    from tokenizers import Tokenizer

    path = queries.word_tokenizer()
    whole = Tokenizer.from_file(path)
    docs = edge_docs.withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("s"), F.col("doc_id") % 3)))
    pieces = packing.pack(docs, path, mixture={"s1": 0.5, "s2": 0.25}).collect()
    by = collections.defaultdict(list)
    for p in pieces:
        by[p["doc_id"]].append(p)
    for r in docs.collect():
        ids = np.array(whole.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        own = sorted(by[r["doc_id"]], key=lambda p: p["start"])
        assert b"".join(p["ids"] for p in own) == ids and {p["doc_tokens"] for p in own} == {len(ids) // 4}
    at = collections.defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == at[p["sequence_id"]]
        at[p["sequence_id"]] += p["length"]
    assert sorted(at) == list(range(len(at))) and all(at[s] == 2048 for s in range(len(at) - 1)) and at[len(at) - 1] <= 2048
    assert packing.pack(docs.where("false"), path).count() == 0


def test_mixture_holds_in_every_window():
    plan = packing.Schedule(np.array([3_000_000, 1_000_000, 500_000]), np.array([3.0, 1.0, 0.5]), 2048, 128)
    seen = np.full(4_500_000, -1, np.int8)
    for q, total in enumerate(plan.totals.tolist()):
        _, first, size, place = plan.cut(q, np.array([0, total // 3]), np.array([total // 3, total - total // 3]))
        for a, n in zip(place.tolist(), size.tolist(), strict=True):
            assert (seen[a : a + n] == -1).all()
            seen[a : a + n] = q
    assert (seen >= 0).all()
    share = np.array([(w == 0).mean() for w in np.split(seen[: 2048 * 2000], 2000)])
    assert abs(share - 2 / 3).max() < 0.15


def test_token_ids_equal_the_library():
    from tokenizers import Tokenizer

    path = queries.word_tokenizer()
    whole, (encode, kind) = Tokenizer.from_file(path), token_ids.encoder(path)
    texts = [t for _, t in documents()] + ["", "a<|endoftext|>b", "don't WE'LL x's", "Straße ǅ ΟΔΟΣ é ½2³", "a b\x1cc", "<| x", "日本語 1,234.5%", "'sa ''re"]
    for text, ids in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(ids, kind).tolist() == whole.encode(text, add_special_tokens=False).ids


# 4
def test_jaccard_edges(spark, edge_docs):
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_groups(edge_docs.withColumn("n", F.lit(1))).collect()}
    assert out[0] == (0, 0) and out[1] == (0, 1) and out[2] == (0, 2) and out[3] == (1, 3) and out[8] == (1, 8)
    assert out[4] == out[5] == out[6] == (8, 4) and len(out) == 12
    assert jaccard_join.jaccard_groups(edge_docs.where("false")).count() == 0


def test_jaccard_finds_every_link(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    texts = []
    for _ in range(120):
        own = list(base)
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(150)] = rng.choice(vocabulary)
        texts.append(" ".join(own[: rng.choice((150, 150, 130, 110, 60))]))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_groups(make_docs(spark, texts)).collect()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    parent = list(range(len(texts)))

    def top(i):
        return i if parent[i] == i else top(parent[i])

    for i, j in itertools.combinations(range(len(texts)), 2):
        k = len(sets[i] & sets[j])
        if 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
            a, b = sorted((top(i), top(j)))
            parent[b] = a
    assert got == {i: top(i) for i in range(len(texts))}


def test_tree_drops_no_pair():
    rng = np.random.default_rng(2)
    sets = [set(rng.choice(400, rng.integers(20, 60), replace=False).tolist()) for _ in range(150)]
    sets += [set(s) - set(list(s)[:3]) for s in sets[:60]]
    bits = np.zeros((len(sets), jaccard_join.BITS), np.uint8)
    for i, s in enumerate(sets):
        bits[i, [x % jaccard_join.BITS for x in s]] = 1
    packed = np.packbits(bits, axis=1).view(np.uint64)
    n = np.array([len(s) for s in sets])
    pairs = {frozenset(p) for p in jaccard_join.tree_pairs(n, np.arange(len(sets)), packed, np.zeros(len(sets), int), 0.75).tolist()}
    for i, j in itertools.combinations(range(len(sets)), 2):
        k = len(sets[i] & sets[j])
        assert k < 0.75 * (n[i] + n[j] - k) or frozenset((i, j)) in pairs


# 5
def test_rule_ensemble(spark, edge_docs):
    rows = {r["doc_id"]: r for r in queries.op5_rule_ensemble(spark, "/root/testdata/sf0.01").collect()}
    quality = dict(duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    held = [d for d in quality if crc(d) % 5 == 0]
    assert all(r["held_out"] == (crc(d) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) for d, r in rows.items())
    assert sum(rows[d]["predicted"] == quality[d] for d in held) >= 0.9 * len(held)
    labels = spark.createDataFrame([(4, 1), (7, 1), (99, 0)], "doc_id long, quality int")
    model = rule_ensemble.learn(edge_docs, labels)
    assert model.rules == () and {round(r["score"], 3) for r in rule_ensemble.score(edge_docs, model).collect()} == {0.75}
    clash = edge_docs.withColumns({n: F.lit(n) for n in ("n_words", "_w", "row", "_f_n_words", "score")})
    for r in rule_ensemble.score(clash, model).collect():
        assert all(r[n] == n for n in ("n_words", "_w", "row", "_f_n_words")) and round(r["score"], 3) == 0.75
    assert rule_ensemble.score(clash.where("false"), model).columns == [*clash.drop("score").columns, "score"]
    assert rule_ensemble.score(clash.where("false"), model).count() == 0
    none = rule_ensemble.learn(edge_docs.where("false"), labels)
    assert none.rules == () and {r["score"] for r in rule_ensemble.score(edge_docs, none).collect()} == {0.5}
    text = "  Tree 0 (weight 1.0):\n    If (feature 0 <= 0.5)\n     If (feature 1 <= 2.0)\n      Predict: 0.0\n     Else (feature 1 > 2.0)\n      Predict: 1.0\n    Else (feature 0 > 0.5)\n     Predict: 1.0"
    assert [r.terms for r in rule_ensemble.tree_rules(text, ["a", "b"])] == [
        (("a", True, 0.5),), (("a", True, 0.5), ("b", True, 2.0)), (("a", True, 0.5), ("b", False, 2.0)), (("a", False, 0.5),)]


# 6
def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Bad.Example.com:80/A/?b=2&a=1&utm_source=x#f", "https://bad.example.com/A?a=1&b=2", "http://x.example.org/es/1", "http://example.org/en/12", "http://org/", "http://a.org", "http://u@b.com/fr/#x"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id int, url string, verdict string")
    listed = spark.createDataFrame([("http://m.bad.example.com/A/?a=1&b=2",), (None,), ("http://m.bad.example.com/A/?a=1&b=2",)], "url string")
    out = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judge_urls(pages, listed, rules=queries.URL_RULES).collect()}
    assert out[0] == out[1] == out[2] == out[3] == ("", "", None, "allow")
    assert out[4] == ("www.bad.example.com:80", "/A/", None, "block") and out[5][3] == "block"
    assert out[6][2:] == ("example.org/es/", "block") and out[7][2:] == ("example.org/en/1", "block") and out[8][2:] == ("org/", "allow")
    assert out[9] == ("a.org", "", None, "allow") and out[10][:3] == ("u@b.com", "/fr/", "com/fr/")
    assert {r["verdict"] for r in url_filters.judge_urls(pages, listed.where("false")).collect()} == {"allow"}


# 7
def test_leaks(spark, edge_docs):
    rows = {(r["doc_id"], r["item_id"]) for r in queries.op7_decontaminate(spark, SF).collect()}
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    assert rows == {(d, i) for d, t in documents() for i, item in items if item in t}
    item = " ".join(f"q{i}" for i in range(40))
    changed = " ".join(f"q{i}" if i % 9 else "other" for i in range(40))
    filler = " ".join(f"f{i}" for i in range(400))
    docs = make_docs(spark, [f"{filler} {item} {filler}", f"{filler} {changed} {filler}", filler, None, ""])
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short")], "item_id int, text string")
    assert {(r[0], r[1]) for r in decontaminate.find_leaks(docs, bench).collect()} == {(0, 1), (1, 1)}
    assert decontaminate.clean_documents(docs, bench).count() == 3
    assert decontaminate.find_leaks(docs, bench.where("false")).count() == 0 and decontaminate.find_leaks(docs.where("false"), bench).count() == 0
    assert decontaminate.find_leaks(edge_docs, bench).count() == 0


def test_basis_of_all_passages(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 9000, 4_500)), "one two three", None, "", " ".join(f"v{x}" for x in rng.integers(0, 400, 700))]
    texts.append(" ".join(["stop", "word"] * 12_000))  # longer than a row of the fit
    docs = make_docs(spark, texts)
    rows = decontaminate.term_rows(docs, "text")
    assert rows.count() == 5
    counts, n = decontaminate.term_counts(rows)
    passages, expected = [], np.zeros_like(counts)
    for text in texts:
        terms = decontaminate._terms(decontaminate._words(pa.array([text or ""]))[0])
        np.add.at(expected, terms, 1)
        passages += [terms[b : b + 96] for b in range(0, max(min(1, len(terms)), len(terms) - 64), 32)]
    assert (counts == expected).all() and n == len(passages)
    weights = decontaminate.term_weights(counts)
    matrix = np.stack([np.bincount(p, weights[p], minlength=len(weights)) for p in passages])
    basis = decontaminate.latent_basis(rows.select("terms", F.lit(1.0).cast("float").alias("weight")), weights).whole()
    # as there are fewer different passages than dimensions, the basis spans every one of them
    left = np.linalg.norm(matrix - matrix @ basis @ basis.T, axis=1)
    assert left.max() < 0.01 * np.linalg.norm(matrix, axis=1).max()


# 8
def test_quality(spark, edge_docs):
    def slow(text):
        words = WORD.findall(text or "")
        lines, seen, copies = (text or "").split("\n"), set(), 0
        for line in lines:
            if WORD.search(line):
                copies += line in seen
                seen.add(line)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        many = collections.Counter(windows)
        inside = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), copies, len(inside)

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = {r["doc_id"]: r for r in queries.op8_quality_rules(spark, SF).collect()}
    for d, text in documents():
        want = slow(text)
        assert tuple(got[d][n] for n in names) == want
        assert got[d]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (got[d]["base_failed"] and got[d]["kept"])
    for r in quality_rules.judge_quality(edge_docs.withColumn("kept", F.lit("clash"))).collect():
        assert tuple(r[n] for n in names) == slow(r["text"])
    assert quality_rules.judge_quality(edge_docs.where("false")).count() == 0


def test_label_model_finds_the_poor_rule(spark):
    rng = random.Random(6)
    truth = {"vote_a": 0.95, "vote_b": 0.7, "vote_c": 0.9, "vote_d": 0.85}
    rows = []
    for _ in range(3000):
        label = 1 if rng.random() < 0.75 else -1
        rows.append(tuple(0 if rng.random() < 0.2 else label if rng.random() < p else -label for p in truth.values()))
    model = quality_rules.fit_label_model(spark.createDataFrame(rows, ", ".join(f"{n} int" for n in truth)), list(truth))
    assert all(abs(model.accuracy[n] - p) < 0.04 for n, p in truth.items()) and abs(model.prior - 0.75) < 0.04
    empty = quality_rules.fit_label_model(spark.createDataFrame([], "vote_a int"), ["vote_a"])
    assert (empty.prior, empty.accuracy) == (0.8, {"vote_a": 0.9})


def test_quality_verdicts_come_from_the_votes(spark):
    got = {r["doc_id"]: r for r in queries.op8_quality_rules(spark, "/root/testdata/sf0.01").collect()}
    quality = dict(duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    fine = [r for d, r in got.items() if quality.get(d) == 1 and not r["base_failed"]]
    poor = [r for d, r in got.items() if quality.get(d) == 0]
    assert sum(r["kept"] for r in fine) >= 0.99 * len(fine) and not any(r["kept"] for r in poor)
    assert sum(not r["base_failed"] and not r["kept"] for r in poor) > 10  # rejected by the model alone


def test_posterior_is_that_of_plain_em(spark):
    names = [f"vote_{n}" for n in quality_rules.rules()]
    voted = quality_rules.judge_votes(quality_rules.quality_votes(spark.read.parquet(f"{SF}/documents.parquet"))).collect()
    rows = [tuple(r[n] for n in names) for r in voted]
    start = {-1: (0.3, 0.03), 0: (0.2, 0.17), 1: (0.5, 0.8)}
    prior, rate = 0.8, [{v: list(p) for v, p in start.items()} for _ in names]

    def good(row):
        bad, fine = 1 - prior, prior
        for v, r in zip(row, rate, strict=True):
            bad, fine = bad * r[v][0], fine * r[v][1]
        return fine / (bad + fine)

    for _ in range(100):
        chance = [good(row) for row in rows]
        mass = (len(rows) - sum(chance), sum(chance))
        for i in range(len(names)):
            for v, p in start.items():
                cast = [0.0, 0.0]
                for row, c in zip(rows, chance, strict=True):
                    if row[i] == v:
                        cast[0] += 1 - c
                        cast[1] += c
                rate[i][v] = [max(0.01, (10 * p[k] + cast[k]) / (10 + mass[k])) for k in (0, 1)]
        prior = min(0.95, max(0.05, (mass[1] + 1) / (len(rows) + 2)))
    for r, row in zip(voted, rows, strict=True):
        assert abs(r["quality_probability"] - good(row)) < 1e-9
        assert r["kept"] == (not r["base_failed"] and good(row) >= 0.5)


def test_quality_keeps_columns_of_any_name(spark, edge_docs):
    clash = edge_docs.withColumns({n: F.lit(n) for n in ("_w", "_t", "_l", "_b", "__k", "_D")})
    plain = {r["doc_id"]: r for r in quality_rules.judge_quality(edge_docs).collect()}
    for r in quality_rules.judge_quality(clash).collect():
        assert all(r[n] == n for n in ("_w", "_t", "_l", "_b", "__k", "_D"))
        assert r.asDict().items() >= plain[r["doc_id"]].asDict().items()


# 9
def test_repeats(spark, edge_docs):
    def slow(texts):
        data = {d: (t or "").encode() for d, t in texts}
        seen = collections.Counter(b[i : i + 200] for b in data.values() for i in range(len(b) - 199))
        out = {}
        for d, b in data.items():
            hit = bytearray(len(b))
            for i in range(len(b) - 199):
                if seen[b[i : i + 200]] > 1:
                    hit[i : i + 200] = b"\1" * 200
            out[d] = (len(b), sum(hit), len(re.findall(b"\1+", bytes(hit))), hashlib.sha256(bytes(c for c, h in zip(b, hit, strict=True) if not h)).hexdigest())
        return out

    assert {r[0]: tuple(r[1:]) for r in queries.op9_suffix_dedup(spark, SF).collect()} == slow(documents())
    small = edge_docs.where("doc_id <> 7")
    cut = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(small).collect()}
    want = slow([(r["doc_id"], r["text"]) for r in small.collect()])
    for d, (size, removed, spans, digest) in want.items():
        assert (cut[d]["n_bytes"], sum(s["end"] - s["begin"] for s in cut[d]["spans"]), len(cut[d]["spans"])) == (size, removed, spans)
        assert hashlib.sha256(cut[d]["kept"]).hexdigest() == digest
    assert suffix_dedup.remove_repeats(small.where("false")).count() == 0


def test_split_anchors_are_merged(spark, monkeypatch):
    rng = random.Random(4)
    shared = "".join(rng.choice("abcdefgh") for _ in range(260))
    texts = ["".join(rng.choice("ijklmnop") for _ in range(220)) + shared + "".join(rng.choice("qrstuv") for _ in range(220)) for _ in range(40)]
    want = [(r["doc_id"], r["spans"]) for r in suffix_dedup.remove_repeats(make_docs(spark, texts)).orderBy("doc_id").collect()]
    monkeypatch.setattr(suffix_dedup, "SHARD_SEGMENTS", 4)
    got = [(r["doc_id"], r["spans"]) for r in suffix_dedup.remove_repeats(make_docs(spark, texts)).orderBy("doc_id").collect()]
    assert got == want and all(len(s) == 1 and s[0]["end"] - s[0]["begin"] >= 260 for _, s in got)


def test_small_shards_together_give_the_pairs_of_their_trees():
    rng = np.random.default_rng(12)
    m = 900
    size, group, side = rng.integers(20, 60, m), rng.integers(0, 5, m), rng.integers(0, 2, m)
    bits = np.zeros((m, jaccard_join.BITS // 64), np.uint64)
    base = rng.integers(0, jaccard_join.BITS, 60)
    for i in range(m):
        for x in np.unique(np.where(rng.random(size[i]) < 0.1, rng.integers(0, jaccard_join.BITS, size[i]), base[: size[i]])):
            bits[i, x // 64] |= np.uint64(1) << np.uint64(x % 64)
    edges = np.concatenate([[0], np.cumsum(rng.integers(1, 33, 100))])
    edges = np.append(edges[edges < m], m)
    want = set()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        want |= {tuple(sorted((int(a + x), int(a + y)))) for x, y in jaccard_join.tree_pairs(size[a:b], group[a:b], bits[a:b], side[a:b], 0.75)}
    got = [(int(x), int(y)) for u, v in jaccard_join.leaf_pairs(edges[:-1], edges[1:], size, group, bits, side, 0.75) for x, y in zip(u, v, strict=True)]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
    none, alone = np.zeros(0, np.int64), np.arange(m)
    for begin, end in ((none, none), (alone, alone + 1)):
        assert not list(jaccard_join.leaf_pairs(begin, end, size, group, bits, side, 0.75))


def test_runs_are_merged_by_search():
    rng = np.random.default_rng(8)
    runs = [np.sort(rng.integers(0, 400, n).astype(np.uint64)) for n in (0, 50, 1, 90, 200)]
    counts = collections.Counter(v for r in runs for v in r.tolist())
    assert suffix_dedup.merged_repeats(runs).tolist() == sorted(v for v, n in counts.items() if n > 1)
    assert suffix_dedup.merged_repeats([]).tolist() == []
    hashes = [(0, runs[3]), (2, runs[4])]
    seen = collections.defaultdict(list)
    for part, blob in suffix_dedup._packed_runs(hashes, [(7, 8), (0, 0), (-9, 10)], 3):
        digest, anchor, whole, which, place = suffix_dedup._unpacked_run(blob)
        assert (np.diff(digest.astype(object)) >= 0).all()
        for d, w, p in zip(digest.tolist(), which.tolist(), place.tolist(), strict=True):
            seen[int(anchor[w]), int(whole[w])].append((p, d))
    assert {k: [d for _, d in sorted(v)] for k, v in seen.items()} == {(7, 8): runs[3].tolist(), (-9, 10): runs[4].tolist()}


def test_long_text_among_short_ones_keeps_its_anchors(spark):
    """A repeated stretch in a text of many pieces and in a short one."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(9))
    shared = " ".join(word() for _ in range(40))
    long = " ".join(word() for _ in range(60_000)) + shared + " ".join(word() for _ in range(60_000))
    rows = suffix_dedup.remove_repeats(make_docs(spark, [long, shared])).orderBy("doc_id").collect()
    assert [[s["end"] - s["begin"] for s in r["spans"]] for r in rows] == [[len(shared)]] * 2


def test_suffix_order():
    data = np.frombuffer(("banana" * 60 + "bandana" * 40).encode(), np.uint8)
    starts = np.arange(len(data) - 200)
    order, common = suffix_dedup.prefix_ranks(data, starts, 200)
    raw = data.tobytes()
    assert [raw[i : i + 200] for i in order] == sorted(raw[i : i + 200] for i in starts)
    for i in range(1, len(order)):
        a, b = raw[order[i - 1] : order[i - 1] + 200], raw[order[i] : order[i] + 200]
        assert common[i] == next((k for k in range(200) if a[k] != b[k]), 200)


# 10
def test_toxicity(spark, edge_docs):
    rows = {r["doc_id"]: r for r in queries.op10_toxicity(spark, "/root/testdata/sf0.1").collect()}
    toxic = dict(duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").fetchall())
    held = [d for d in toxic if crc(d) % 5 == 0]
    assert all(r["held_out"] == (crc(d) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) for d, r in rows.items())
    hits = [rows[d]["predicted"] for d in held if toxic[d] == 1]
    assert sum(hits) >= 0.8 * len(hits) and sum(rows[d]["predicted"] for d in held if toxic[d] == 0) <= 0.02 * len(held)
    model = toxicity.learn(edge_docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(edge_docs, model).collect()} == {0.5}
    assert toxicity.score(edge_docs.where("false"), model).count() == 0


def test_model_is_sparse_and_learns_words():
    texts = ["good calm day today"] * 30 + ["you nasty thing today"] * 30
    model = toxicity.fit(texts, [0] * 30 + [1] * 30)
    data = b"calm daynasty" + b""
    scores = model.score(np.frombuffer(data, np.uint8), np.array([0, 8, 13, 13]))
    assert scores[0] < 0.5 < scores[1] and len(model.buckets) < 60
