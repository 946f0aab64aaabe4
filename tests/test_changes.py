import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from tidemark.operators.changes import changed_rows, first_batch_rows, keep_changes, new_rows
from tidemark.operators.joins import decode, link_history, link_history_as_of, unknown_codes
from tidemark.operators.keys import KeyViolation, as_of_view, check_key, key_violations, latest_per_key, null_keys

SCHEMA = "k string, d date, a string, n int"


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def random_series(seed, keys=6, days=8):
    """Snapshots with gaps, NULLs and values that come back."""
    rng = random.Random(seed)
    return [
        (f"k{k}", day(d), rng.choice("AB"), rng.choice([None, 1, 2, 2, 2]))
        for d in range(days) for k in range(keys) if rng.random() < 0.8
    ]


def equal(left, right, null_safe):
    if null_safe:
        return left == right
    return None not in left and None not in right and left == right


def fold(rows, null_safe):
    """Apply the snapshots one at a time, oldest first."""
    latest, stored = {}, []
    for row in sorted(rows, key=lambda r: r[1]):
        key, values = row[0], (row[0], *row[2:])
        if key not in latest or not equal(latest[key], values, null_safe):
            latest[key] = values
            stored.append(row)
    return sorted(stored, key=repr)


@pytest.mark.parametrize("null_equality", ["sql", "null_safe"])
def test_one_pass_equals_fold(spark, null_equality):
    for seed in range(6):
        rows = random_series(seed)
        kept = keep_changes(spark.createDataFrame(rows, SCHEMA), "k", "d", null_equality)
        assert kept.columns == ["k", "d", "a", "n"]
        assert rows_of(kept) == fold(rows, null_equality == "null_safe")


@pytest.mark.parametrize("null_equality", ["sql", "null_safe"])
def test_one_pass_with_baseline_equals_fold(spark, null_equality):
    for seed in range(3):
        rows = random_series(seed)
        whole = fold(rows, null_equality == "null_safe")
        before = [r for r in whole if r[1] < day(4)]
        baseline = latest_per_key(spark.createDataFrame(before, SCHEMA), ["k"], "d")
        late = spark.createDataFrame([r for r in rows if r[1] >= day(4)], SCHEMA)
        kept = keep_changes(late, "k", "d", null_equality, baseline)
        assert rows_of(kept) == [r for r in whole if r[1] >= day(4)]


@pytest.mark.parametrize("null_equality", ["sql", "null_safe"])
def test_anti_join_folded_over_days_equals_fold(spark, null_equality):
    rows = random_series(11, days=4)
    stored = []
    for d in range(4):
        staged = spark.createDataFrame([r for r in rows if r[1] == day(d)], SCHEMA)
        master = spark.createDataFrame(stored, SCHEMA)
        stored += [tuple(r) for r in changed_rows(staged, master, "k", "d", null_equality).collect()]
    assert sorted(stored, key=repr) == fold(rows, null_equality == "null_safe")


def test_changed_rows_cases(spark):
    master = spark.createDataFrame([
        ("same", day(0), "A", 1), ("changed", day(0), "A", 1), ("back", day(0), "A", 1), ("back", day(1), "B", 1),
        ("null", day(0), "A", None),
    ], SCHEMA)
    staged = spark.createDataFrame([
        ("same", day(2), "A", 1), ("changed", day(2), "B", 1), ("back", day(2), "A", 1), ("null", day(2), "A", None), ("new", day(2), "A", 1),
    ], SCHEMA)
    keys = lambda **options: [r[0] for r in rows_of(changed_rows(staged, master, "k", "d", **options))]
    assert keys() == ["back", "changed", "new", "null"]
    assert keys(null_equality="null_safe") == ["back", "changed", "new"]
    # As of day 1 the newer row of `back` does not count.
    assert keys(null_equality="null_safe", as_of=day(1)) == ["changed", "new"]
    with pytest.raises(ValueError, match="null_equality"):
        changed_rows(staged, master, "k", "d", "whatever")


def test_changed_rows_uses_a_stored_digest(spark):
    from tidemark.functions import row_digest

    master = spark.createDataFrame([("k", day(0), "A", 1)], SCHEMA).withColumn("h", row_digest(["k", "a", "n"]))
    staged = spark.createDataFrame([("k", day(1), "A", 1), ("l", day(1), "A", 1)], SCHEMA)
    assert [r[0] for r in rows_of(changed_rows(staged, master.drop("a", "n"), "k", "d", digest="h"))] == ["l"]


def log_fold(batches):
    stored, seen = [], set()
    for batch, rows in batches:
        new = [r for r in rows if tuple("" if v is None else v for v in r) not in seen]
        seen |= {tuple("" if v is None else v for v in r) for r in new}
        stored += [(*r, batch) for r in new]
    return sorted(stored, key=repr)


def random_batches(seed):
    rng = random.Random(seed)
    return [(b, [(rng.choice("xyz"), rng.choice(["", None, "q"])) for _ in range(rng.randrange(8))]) for b in range(5)]


def test_first_batch_equals_fold(spark):
    for seed in range(6):
        batches = random_batches(seed)
        flat = [(*r, b) for b, rows in batches for r in rows]
        df = spark.createDataFrame(flat, "a string, b string, batch int")
        assert rows_of(first_batch_rows(df, "batch")) == log_fold(batches)
        deduped = first_batch_rows(df, "batch", intra_batch="dedupe")
        prints = deduped.select(F.coalesce("a", F.lit("")), F.coalesce("b", F.lit("")))
        assert prints.distinct().count() == deduped.count() == len({(a, b or "") for a, b, _ in log_fold(batches)})


def test_new_rows_keep_and_dedupe(spark):
    schema = "a string, b string"
    master = spark.createDataFrame([("old", None)], schema)
    staged = spark.createDataFrame([("old", ""), ("new", ""), ("new", ""), ("new", None)], schema)
    assert rows_of(new_rows(staged, master)) == sorted([("new", ""), ("new", ""), ("new", None)], key=repr)
    assert rows_of(new_rows(staged, master, intra_batch="dedupe")) == [("new", None)]


def test_latest_and_as_of(spark):
    df = spark.createDataFrame([("k", day(0), "A", 1), ("k", day(2), "B", 1), ("k", day(2), "C", 0), ("l", None, "Z", 9)], SCHEMA)
    assert rows_of(latest_per_key(df, ["k"], "d", ["a"])) == [("k", day(2), "C", 0), ("l", None, "Z", 9)]
    assert rows_of(as_of_view(df, ["k"], "d", day(1))) == [("k", day(0), "A", 1)]


def test_key_checks(spark):
    df = spark.createDataFrame([("k", day(0), "A", 1), ("k", day(0), "B", 1), (None, day(0), "A", 1)], SCHEMA)
    assert rows_of(key_violations(df, ["k", "d"])) == [("k", day(0), 2)]
    assert null_keys(df, ["k", "d"]).count() == 1
    with pytest.raises(KeyViolation, match="1 values repeat, 1 rows have a NULL"):
        check_key(df, ["k", "d"])
    check_key(df.limit(0), ["k"])


def test_links(spark):
    reg = spark.createDataFrame([("k", day(0), "A", 1), ("k", day(4), "B", 1), ("l", day(9), "C", 1)], SCHEMA)
    his = spark.createDataFrame([("k", day(3), 1), ("k", day(4), 2), ("k", day(8), 3), ("k", day(8), 3), ("l", day(1), 4), ("x", day(1), 5)], "k string, e date, id int")
    now = link_history(reg, his, "k", "d").select("id", "a")
    assert rows_of(now) == [(1, "B"), (2, "B"), (3, "B"), (3, "B"), (4, "C")]
    then = link_history_as_of(reg, his, "k", "d", "e").select("id", "a", "d")
    assert rows_of(then) == [(1, "A", day(0)), (2, "B", day(4)), (3, "B", day(4)), (3, "B", day(4))]
    left = link_history_as_of(reg, his, "k", "d", "e", how="left").select("id", "a")
    assert rows_of(left) == [(1, "A"), (2, "B"), (3, "B"), (3, "B"), (4, None), (5, None)]


def test_as_of_link_equals_brute_force(spark):
    rng = random.Random(3)
    reg = [(rng.choice("kl"), day(rng.randrange(20)), i) for i in range(15)]
    his = [(rng.choice("klm"), day(rng.randrange(22)), i) for i in range(40)]
    expected = []
    for k, e, i in his:
        older = [(d, v) for kk, d, v in reg if kk == k and d <= e]
        if older:
            expected.append((k, e, i, *max(older)))
    got = link_history_as_of(
        spark.createDataFrame(reg, "k string, d date, v int"), spark.createDataFrame(his, "k string, e date, i int"), "k", "d", "e", ["v"]
    )
    assert rows_of(got) == sorted(expected, key=repr)


def test_decode_and_unknown_codes(spark):
    from tidemark.sources.tables import dim_county

    df = spark.createDataFrame([("1",), ("00",), ("100",), ("100",), (None,)], "county_id string")
    decoded = decode(df, "county_id", dim_county(spark), "county_id", "county_name", "county")
    assert rows_of(decoded) == sorted([("1", "ALAMANCE"), ("00", "YANCEY"), ("100", None), ("100", None), (None, None)], key=repr)
    assert rows_of(unknown_codes(df, "county_id", dim_county(spark), "county_id")) == sorted([("100", 2), (None, 1)], key=repr)
