"""What operators leave behind, and the work that they save without losing a result."""

import itertools
import pathlib
import random

import numpy as np
import pyarrow as pa
from llm.conftest import make_docs

from tidemark.llm import common, decontaminate, jaccard_join, line_dedup, packing, token_ids
from tidemark.llm.common import connected_components
from tidemark.llm.queries import word_tokenizer


def kept(spark):
    """Tables in the shared folder, by purpose."""
    return [p.name.rsplit("-", 1)[0] for p in pathlib.Path(spark.sparkContext.getConf().get("spark.checkpoint.dir")).iterdir()]


def added(spark, act):
    """The tables that `act` leaves in the shared folder."""
    before = kept(spark)
    act()
    after = kept(spark)
    for name in before:
        after.remove(name)
    return after


# pipeline
def test_working_tables_are_deleted(spark):
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(words) + f"\nline of its own number {i}\n" + " ".join(words[:25] + [f"x{i}"] * 5) for i in range(6)]
    docs = make_docs(spark, texts)
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)], "src long, dst long")
    assert added(spark, lambda: connected_components(edges).count()) == ["edges"]
    left = added(spark, lambda: jaccard_join.jaccard_groups(docs).collect())
    assert set(left) <= {"sizes", "links", "edges"} and left.count("edges") <= 2
    left = added(spark, lambda: line_dedup.dedup_lines(docs).collect())
    assert set(left) <= {"gone", "links", "edges"} and left.count("edges") <= 2


# op4
def phrased(count):
    """Long texts of random words with some of the same common phrases; every third is a near copy of the one before."""
    rng = random.Random(4)
    phrases = [[f"p{k}x{i}" for i in range(6)] for k in range(12)]
    texts = []
    for i in range(count):
        if i % 3 == 2:
            own = texts[-1].split()
            for _ in range(rng.choice((2, 8, 14))):
                own[rng.randrange(len(own))] = f"odd{rng.random()}"
        else:
            own = [f"w{rng.randrange(10**6)}" for _ in range(400)]
            for phrase in rng.sample(phrases, 6):
                at = rng.randrange(390)
                own[at : at + 6] = phrase
        texts.append(" ".join(own))
    return texts


def brute_force(texts):
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    top = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        k = len(sets[i] & sets[j])
        if 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
            top = [min(top[i], top[j]) if x in (top[i], top[j]) else x for x in top]
    return dict(enumerate(top))


def test_common_shingles_make_no_pairs_and_lose_no_link(spark, monkeypatch):
    texts = phrased(90)
    monkeypatch.setattr(jaccard_join, "HOT", 2)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 1)  # or the phrases come last in the order
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_groups(make_docs(spark, texts)).collect()}
    assert got == brute_force(texts)


def test_sets_without_enough_common_shingles_are_left_out(spark):
    """A set of 400 shingles needs 16 at least in common with any that it links with."""
    rows = [(s, i, i) for i in range(50) for s in range(3)]  # three phrases that all have
    rows += [(100 + s, i, i) for i in (0, 1) for s in range(20)]  # two that have much in common
    rows += [(1000 + s, 60 + i, 60 + i) for i in range(40) for s in range(30)]  # sets with many common shingles
    placed = spark.createDataFrame(rows, "shingle long, id long, grp long")
    groups = spark.createDataFrame([(i, 400, i) for i in range(100)], "id long, n long, grp long")
    out = [tuple(r) for r in jaccard_join.met_shingles(placed, groups, 0.75).collect()]
    assert {r[1] for r in out} == {0, 1, *range(60, 100)}
    assert {(r[0], r[4]) for r in out if r[1] < 2} == {(100 + s, 3) for s in range(20)}
    assert sum(r[1] >= 60 for r in out) == 40 * 30 and {r[4] for r in out if r[1] >= 60} == {0}


# op7
def test_products_of_short_and_long_rows():
    rng = np.random.default_rng(6)
    size, width = 1 << decontaminate.TERM_BITS, 5
    rows = [(rng.zipf(1.3, n) % size).astype("<u2") for n in (1, 31, 32, 33, 64, 65, 95, 96, 97, 2000, 9000)]
    scale = rng.random(len(rows))
    weights = np.where(rng.random(size) < 0.1, 0, rng.random(size)).astype(np.float32)
    expected = {}
    dense = rng.standard_normal((size, width)).astype(np.float32)
    sparse = rng.integers(0, width, size), rng.choice(np.array([-1.0, 1.0], np.float32), size)
    spread = np.zeros((size, width))
    spread[np.arange(size), sparse[0]] = sparse[1]
    for name, v in (("dense", dense), ("sparse", spread)):
        expected[name] = np.zeros((size, width))
        for terms, factor in zip(rows, scale, strict=True):
            for b in range(0, max(1, len(terms) - 64), 32):
                own = terms[b : b + 96]
                np.add.at(expected[name], own, factor**2 * (v[own] * weights[own, None]).sum(axis=0))
        expected[name][weights == 0] = 0
    given = {"dense": np.concatenate([dense * weights[:, None], np.zeros((1, width), np.float32)]), "sparse": (sparse[0], sparse[1] * weights)}
    for name, v in given.items():
        out = np.zeros((size, width), np.float32)
        decontaminate._add_products(out, v, weights != 0, [r.tobytes() for r in rows], scale)
        assert np.abs(out - expected[name]).max() < 1e-4 * np.abs(expected[name]).max()


def test_few_rows_are_taken_in_vain():
    rest = np.sort(np.bincount(np.random.default_rng(7).zipf(1.4, 200_000) % 16384, minlength=16384) % 64)[::-1]
    rest = rest[rest > 0]
    batches = list(decontaminate._batches(rest))
    assert [b[0] for b in batches[1:]] == [b[1] for b in batches[:-1]] and batches[-1][1] == len(rest)
    assert sum((b - a) * most for a, b, most in batches) < 1.2 * rest.sum() + 1024  # all pieces had 16 rows before


def test_a_passage_is_read_once_for_all_its_items():
    reads = []

    class Words(np.ndarray):
        def tolist(self):
            reads.append(len(self))
            return super().tolist()

    rng = np.random.default_rng(8)
    text = rng.integers(0, 1 << 63, 96, dtype=np.uint64) * np.uint64(2)
    projection = np.concatenate([rng.standard_normal((1 << decontaminate.TERM_BITS, 64)).astype(np.float32), np.zeros((1, 64), np.float32)])
    items = [text[k : k + 40] for k in range(30)]
    latent = np.stack([projection[decontaminate._terms(w)].sum(axis=0) for w in items])
    q = decontaminate.Queries(list(range(30)), items, latent, projection)
    lists = [w.tolist() for w in items]
    found = decontaminate._search(text.view(Words), np.array([0, 96]), q, (latent**2).sum(axis=1), lists, [w[-10:] for w in lists], 0.75, (0.6, 0.8))
    assert {f: v[1:] for f, v in found.items()} == {(0, i): (1.0, 1.0) for i in range(30)}
    assert len(reads) <= 3  # one for each passage that begins in the text; 30 and more before


# op2
def test_lines_are_taken_out_in_one_way_at_any_size(spark):
    """The join with the texts is dealt by key on small tables too, not broadcast."""
    docs = make_docs(spark, ["one two three four five six", "one two three four five six\nseven", None, "x"])
    out = line_dedup.dedup_lines(docs)
    assert {r["doc_id"]: r["n_lines_removed"] for r in out.collect()} == {0: 0, 1: 1, 2: 0, 3: 0}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan


# pipeline
def test_last_components_start_from_the_first_forest(spark, monkeypatch):
    """Copies of a linked text are no chain by then."""
    given = []

    def seen(edges, *args):
        given.append([(r["src"], r["dst"]) for r in edges.collect()])
        return connected_components(edges, *args)

    monkeypatch.setattr(jaccard_join, "connected_components", seen)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[:-1]), " ".join(words[:-1])]
    assert {r["component_id"] for r in jaccard_join.jaccard_groups(make_docs(spark, texts)).collect()} == {0}
    first, last = given
    assert {s for s, _ in first} & {d for _, d in first} == {1}
    assert not {s for s, _ in last} & {d for _, d in last}


# pipeline
def test_plans_of_component_rounds_are_short(spark, monkeypatch):
    """One join a plan; both steps of a round in one plan had four, as a step that is used twice is planned twice."""
    joins, stored = [], common._stored

    def seen(df, purpose):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join"))
        return stored(df, purpose)

    monkeypatch.setattr(common, "_stored", seen)
    rng = random.Random(9)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)] + [(400, i) for i in range(401, 440)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    top = {n: n for e in edges for n in e if None not in e and e[0] != e[1]}
    for _ in top:
        for a, b in edges:
            if a in top and b in top:
                top[a] = top[b] = min(top[a], top[b])
    assert got == top
    assert max(joins) == 1


def test_trees_of_lines_are_planned_apart(spark, monkeypatch):
    """Lines of equal hashes and lines of near ones are two tables; their union had four joins."""
    joins, stored = [], common._stored

    def seen(df, purpose):
        joins.append((purpose, df._jdf.queryExecution().optimizedPlan().toString().count("Join")))
        return stored(df, purpose)

    monkeypatch.setattr(common, "_stored", seen)
    line_dedup.dedup_lines(make_docs(spark, ["one two three four five six", "one two three four five six\nseven", None, "x"])).collect()
    assert max(n for purpose, n in joins if purpose == "spots") <= 2


def test_the_driver_loads_no_tokenizer(spark, monkeypatch):
    monkeypatch.setattr(token_ids, "_loaded", {})
    texts = ["some words, and more", None, "", "x " * 3000]
    pieces = packing.pack(make_docs(spark, texts), word_tokenizer()).collect()
    assert not token_ids._loaded
    whole = dict(zip(range(4), token_ids.encoder(word_tokenizer())[0]([t or "" for t in texts]), strict=True))
    for i, own in whole.items():
        ids = b"".join(bytes(p["ids"]) for p in sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"]))
        assert np.frombuffer(ids, "<u4").tolist() == [*np.frombuffer(own, "<u2").tolist(), 1]


def test_ids_of_either_width_are_read():
    for kind in ("<u2", "<u4"):
        rows = [[5, 6, 7], [], [65535]]
        column = pa.array([b"left out"] + [np.array(r, kind).tobytes() for r in rows], pa.binary()).slice(1)
        data, begin = packing._blobs(column, np.array([3, 0, 1]))
        assert data.tolist() == [5, 6, 7, 65535] and begin.tolist() == [0, 3, 3]
