import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import participation, registration, rows_of, write_snapshot
from tidemark import schemas
from tidemark.operators.keys import KeyViolation
from tidemark.plans import feeds
from tidemark.plans.incremental import Pipeline, run_incremental
from tidemark.sinks.backups import DamagedBackup, backup_table, restore_backup
from tidemark.sinks.tables import ConcurrentCommit, Draft, NothingToRebuild, remove_old_versions
from tidemark.sources.ledger import read_ledger
from tidemark.sources.manifest import current_manifest
from tidemark.sources.tables import read_side
from tidemark.streaming.snapshots import ignored_files, stream_participations, stream_registrations

REG, PART = schemas.REGISTRATION_COLUMNS, schemas.PARTICIPATION_COLUMNS


def reg_file(folder, stamp, rows, columns=REG):
    return write_snapshot(f"{folder}/{stamp}_people.txt", rows, columns)


def part_file(folder, stamp, rows):
    return write_snapshot(f"{folder}/{stamp}_turnout.txt", rows, PART)


def stored(spark, table):
    df = feeds.read_registrations(spark, table)
    return rows_of(df.select("ncid", df["data_date"].cast("string"), "party_cd", "birth_year"))


def logged(spark, table):
    df = feeds.read_participations(spark, table)
    return rows_of(df.select("ncid", df["election_lbl"].cast("string"), "voting_method", df["data_date"].cast("string")))


WEEKS = [
    ("20240101", [registration("1", party_cd="A"), registration("2", party_cd="A"), registration("3", birth_year="")]),
    ("20240108", [registration("1", party_cd="B"), registration("2", party_cd="A"), registration("3", birth_year="")]),
    ("20240115", [registration("1", party_cd="A"), registration("3", birth_year="x"), registration("4", party_cd=" A  ")]),
    ("20240122", [registration("1", party_cd="A"), registration("2", party_cd="A"), registration("4", party_cd="A")]),
]
STORED_SQL = [
    ("1", "2024-01-01", "A", 1980), ("1", "2024-01-08", "B", 1980), ("1", "2024-01-15", "A", 1980), ("2", "2024-01-01", "A", 1980),
    ("3", "2024-01-01", "", None), ("3", "2024-01-08", "", None), ("3", "2024-01-15", "", None), ("4", "2024-01-15", "A", 1980),
]
STORED_NULL_SAFE = [r for r in STORED_SQL if r[:2] not in {("3", "2024-01-08"), ("3", "2024-01-15")}]


@pytest.mark.parametrize("null_equality, expected", [("sql", STORED_SQL), ("null_safe", STORED_NULL_SAFE)])
def test_registration_snapshots_one_by_one_rebuilt_and_streamed(spark, tmp_path, null_equality, expected):
    table = str(tmp_path / "table")
    reports = []
    for stamp, rows in WEEKS:
        path = reg_file(tmp_path / "in", stamp, rows)
        reports.append(feeds.apply_registration(spark, path, stamp, table, null_equality))
    assert stored(spark, table) == expected
    assert [r.staged for r in reports] == [3, 3, 3, 3]
    assert sum(r.inserted for r in reports) == len(expected)
    assert [r.failed_values for r in reports] == [0, 0, 1, 0]

    # Applying the newest one again stores the same rows; an older one is refused.
    again = feeds.apply_registration(spark, path, stamp, table, null_equality)
    assert again.inserted == reports[-1].inserted and stored(spark, table) == expected
    with pytest.raises(feeds.LateSnapshot):
        feeds.apply_registration(spark, path, "20240110", table, null_equality)

    rebuilt = str(tmp_path / "rebuilt")
    assert feeds.rebuild_registration(spark, str(tmp_path / "in"), "people", rebuilt, null_equality) == len(expected)
    assert stored(spark, rebuilt) == expected
    # A rebuild replaces the table and knows the newest date even if it stored nothing.
    assert feeds.rebuild_registration(spark, str(tmp_path / "in"), "people", rebuilt, null_equality) == len(expected)
    with pytest.raises(feeds.LateSnapshot):
        feeds.apply_registration(spark, path, "20240121", rebuilt, null_equality)

    streamed, checkpoint = str(tmp_path / "streamed"), str(tmp_path / "checkpoint")
    for stamp, rows in WEEKS[:2]:
        reg_file(tmp_path / "arriving", stamp, rows)
    stream_registrations(spark, str(tmp_path / "arriving"), "people", streamed, checkpoint, null_equality).awaitTermination()
    for stamp, rows in WEEKS[2:]:
        reg_file(tmp_path / "arriving", stamp, rows)
    stream_registrations(spark, str(tmp_path / "arriving"), "people", streamed, checkpoint, null_equality).awaitTermination()
    assert stored(spark, streamed) == expected


def test_replay_of_a_snapshot_with_null_values_is_idempotent(spark, tmp_path):
    table = str(tmp_path / "table")
    path = reg_file(tmp_path, "20240101", [registration("1", birth_year="")])
    for _ in range(2):
        assert feeds.apply_registration(spark, path, "20240101", table).inserted == 1
    assert len(stored(spark, table)) == 1
    # A second publication of the day replaces the first one.
    path = reg_file(tmp_path, "20240101", [registration("2")])
    feeds.apply_registration(spark, path, "20240101", table)
    assert [r[0] for r in stored(spark, table)] == ["2"]


def test_repeated_key_in_a_snapshot_stores_nothing(spark, tmp_path):
    table = str(tmp_path / "table")
    twice = [registration("1", party_cd="A"), registration("1", party_cd="B")]
    path = reg_file(tmp_path / "in", "20240101", twice)
    with pytest.raises(KeyViolation):
        feeds.apply_registration(spark, path, "20240101", table)
    assert stored(spark, table) == []
    with pytest.raises(KeyViolation):
        feeds.rebuild_registration(spark, str(tmp_path / "in"), "people", table)
    feeds.rebuild_registration(spark, str(tmp_path / "in"), "people", table, ties=["party_cd"])
    assert [r[2] for r in stored(spark, table)] == ["B"]


def test_long_row_stores_nothing(spark, tmp_path):
    path = reg_file(tmp_path, "20240101", [registration("1", vtd_desc="X\tY")])
    with pytest.raises(Exception, match="too many fields"):
        feeds.apply_registration(spark, path, "20240101", str(tmp_path / "table"))
    assert stored(spark, str(tmp_path / "table")) == []


def test_mixed_layouts_and_column_orders(spark, tmp_path):
    folder = tmp_path / "in"
    old = registration("1", party_cd="A") | {"birth_age": "41", "absent_ind": "", "dist_2_abbrv": "x"}
    reg_file(folder, "20220101", [old], schemas.PREVIOUS_REGISTRATION_COLUMNS)
    shuffled = [c for c in reversed(REG) if c != "drivers_lic"] + ["surprise"]
    reg_file(folder, "20220301", [registration("1", party_cd="A", age_at_year_end="41", surprise="!")], shuffled)
    table = str(tmp_path / "table")
    feeds.rebuild_registration(spark, str(folder), "people", table, "null_safe")
    df = feeds.read_registrations(spark, table)
    assert df.columns == schemas.REGISTRATION_TABLE.names
    rows = df.orderBy("data_date").select("age_at_year_end", "drivers_lic").collect()
    # The absent column is NULL, which differs from ''.
    assert [tuple(r) for r in rows] == [(41, ""), (41, None)]


def test_rebuild_without_snapshots_leaves_the_table(spark, tmp_path):
    table = str(tmp_path / "table")
    (tmp_path / "in").mkdir()
    feeds.apply_registration(spark, reg_file(tmp_path, "20240101", [registration("1")]), "20240101", table)
    with pytest.raises(NothingToRebuild):
        feeds.rebuild(spark, str(tmp_path / "in"), {"registration": ("people", table)}, {"registration"})
    assert len(stored(spark, table)) == 1
    with pytest.raises(ValueError, match="unknown tables"):
        feeds.rebuild(spark, str(tmp_path / "in"), {}, {"everything"})


def test_rebuild_refuses_or_leaves_out_files_without_a_date(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "table")
    part_file(folder, "20240101", [participation("1")])
    write_snapshot(folder / "turnout.txt", [participation("2")], PART)
    with pytest.raises(ValueError, match="without a date"):
        feeds.rebuild_participation(spark, str(folder), "turnout", table)
    assert feeds.rebuild_participation(spark, str(folder), "turnout", table, undated="skip") == 1
    (folder / "20240108_turnout.zip").write_bytes(b"PK")
    with pytest.raises(ValueError, match="not text files"):
        feeds.rebuild_participation(spark, str(folder), "turnout", table, undated="skip")
    assert [r[0] for r in logged(spark, table)] == ["1"]


def random_log(seed):
    rng = random.Random(seed)
    weeks = ["20240101", "20240108", "20240115"]
    method = lambda: rng.choice(["IN-PERSON", "ABSENTEE", ""])
    return [(w, [participation(rng.choice("123"), voting_method=method()) for _ in range(6)]) for w in weeks]


@pytest.mark.parametrize("intra_batch", ["keep", "dedupe"])
def test_participation_one_by_one_rebuilt_and_streamed(spark, tmp_path, intra_batch):
    table, seen, expected = str(tmp_path / "table"), set(), []
    for stamp, rows in random_log(5):
        path = part_file(tmp_path / "in", stamp, rows)
        report = feeds.apply_participation(spark, path, stamp, table, intra_batch)
        date = dt.datetime.strptime(stamp, "%Y%m%d").date().isoformat()
        new = [(r["ncid"], "2020-11-03", r["voting_method"], date) for r in rows if (r["ncid"], r["voting_method"]) not in seen]
        new = new if intra_batch == "keep" else sorted(set(new))
        seen |= {(r[0], r[2]) for r in new}
        assert (report.staged, report.inserted) == (6, len(new))
        expected += new
    expected.sort(key=repr)
    assert logged(spark, table) == expected
    feeds.apply_participation(spark, path, stamp, table, intra_batch)
    assert logged(spark, table) == expected
    rebuilt = str(tmp_path / "rebuilt")
    feeds.rebuild_participation(spark, str(tmp_path / "in"), "turnout", rebuilt, intra_batch)
    assert logged(spark, rebuilt) == expected
    streamed = str(tmp_path / "streamed")
    stream_participations(spark, str(tmp_path / "in"), "turnout", streamed, str(tmp_path / "checkpoint"), intra_batch).awaitTermination()
    assert logged(spark, streamed) == expected


def test_stream_fills_short_rows_and_refuses_long_ones(spark, tmp_path):
    path = write_snapshot(tmp_path / "in" / "20240101_people.txt", [registration("1")], REG)
    with open(path, "a") as file:
        file.write("\t".join(["1", "X", "", "2"]) + "\n")
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    stream_registrations(spark, str(tmp_path / "in"), "people", table, checkpoint).awaitTermination()
    assert [r[0] for r in stored(spark, table)] == ["1", "2"]
    reg_file(tmp_path / "in", "20240108", [registration("1", vtd_desc="X\tY")])
    with pytest.raises(Exception):
        stream_registrations(spark, str(tmp_path / "in"), "people", table, checkpoint).awaitTermination()


def test_stream_refuses_a_late_file_of_a_date_it_has_read(spark, tmp_path):
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    run = lambda: stream_registrations(spark, str(tmp_path / "in"), "people", table, checkpoint).awaitTermination()
    write_snapshot(tmp_path / "in" / "20240101_people.a.txt", [registration("1")], REG)
    write_snapshot(tmp_path / "in" / "20240101_people.b.txt", [registration("2")], REG)
    run()
    write_snapshot(tmp_path / "in" / "20240101_people.c.txt", [registration("3")], REG)
    with pytest.raises(Exception, match="was read by an earlier run"):
        run()
    assert [r[0] for r in stored(spark, table)] == ["1", "2"]


def pipeline(tmp_path):
    return Pipeline(
        landing=str(tmp_path / "in"), registration_stem="people", participation_stem="turnout",
        registration_table=str(tmp_path / "registrations"), participation_table=str(tmp_path / "participations"),
        backup_folder=str(tmp_path / "backup"), ledger=str(tmp_path / "ledger"),
    )


def test_incremental_run(spark, tmp_path):
    job = pipeline(tmp_path)
    part_file(tmp_path / "in", "20240101", [participation("1")])
    for stamp, rows in reversed(WEEKS[:2]):
        reg_file(tmp_path / "in", stamp, rows)
    report = run_incremental(spark, job, raise_errors=True)
    assert list(report.applied) == ["20240101_people.txt", "20240108_people.txt", "20240101_turnout.txt"]
    assert report.backed_up and report.error is None
    before = stored(spark, job.registration_table)
    assert before == [r for r in STORED_SQL if r[1] <= "2024-01-08"]
    assert {(r.processed, r.archived) for r in read_ledger(spark, job.ledger).collect()} == {(True, True)}

    # Nothing new: nothing happens.
    again = run_incremental(spark, job, raise_errors=True)
    assert not again.applied and not again.backed_up

    # A broken file stops the run, stays unfinished and is retried without another backup.
    good = reg_file(tmp_path / "in", "20240122", WEEKS[3][1])
    broken = reg_file(tmp_path / "in", "20240115", [registration("1", vtd_desc="X\tY")])
    failed = run_incremental(spark, job)
    assert failed.error is not None and not failed.applied and failed.backed_up
    assert stored(spark, job.registration_table) == before
    # The backup shows the tables before the run.
    backup = restore_backup(spark, f"{job.backup_folder}/registration", schemas.REGISTRATION_TABLE)
    assert rows_of(backup) == rows_of(feeds.read_registrations(spark, job.registration_table))
    open_files = [r.file_name for r in read_ledger(spark, job.ledger).where("NOT processed").orderBy("file_name").collect()]
    assert open_files == ["20240115_people.txt", "20240122_people.txt"]

    import os
    time = os.stat(broken).st_mtime
    reg_file(tmp_path / "in", "20240115", WEEKS[2][1])
    os.utime(broken, (time, time))  # the same publication, now readable
    retried = run_incremental(spark, job, raise_errors=True)
    assert list(retried.applied) == ["20240115_people.txt", "20240122_people.txt"] and not retried.backed_up
    assert stored(spark, job.registration_table) == STORED_SQL
    assert good


def test_files_of_one_date_are_one_snapshot(spark, tmp_path):
    job = pipeline(tmp_path)
    write_snapshot(tmp_path / "in" / "20240101_people.a.txt", [registration("1")], REG)
    write_snapshot(tmp_path / "in" / "20240101_people.b.txt", [registration("2")], REG)
    report = run_incremental(spark, job, raise_errors=True)
    assert list(report.applied) == ["20240101_people.a.txt, 20240101_people.b.txt"]
    assert [r[0] for r in stored(spark, job.registration_table)] == ["1", "2"]
    # One of the files comes again: the whole date is read again.
    import os
    path = write_snapshot(tmp_path / "in" / "20240101_people.b.txt", [registration("3")], REG)
    os.utime(path, (1, 1))
    run_incremental(spark, job, raise_errors=True)
    assert [r[0] for r in stored(spark, job.registration_table)] == ["1", "3"]


def test_undated_file_takes_the_date_of_its_timestamp(spark, tmp_path):
    job = pipeline(tmp_path)
    path = write_snapshot(tmp_path / "in" / "people.txt", [registration("1")], REG)
    listing = spark.createDataFrame(
        [(path, "people.txt", "people", None, "Sun, 07 Jan 2024 23:59:59 GMT"), (path, "other.txt", "people", None, "unreadable")],
        "path string, file_name string, stem string, stamp string, timestamp string",
    )
    report = run_incremental(spark, job, listing, raise_errors=True)
    assert list(report.applied) == ["people.txt"]
    assert [r[1] for r in stored(spark, job.registration_table)] == ["2024-01-07"]


def test_state_of_latest_rows_is_only_a_shortcut(spark, tmp_path):
    """With the state, without it, and after a rebuild the same rows are stored."""
    table, plain = str(tmp_path / "table"), str(tmp_path / "plain")
    states = lambda t: sorted(n for n in current_manifest(spark, t).sides if n.startswith("latest:"))
    for stamp, rows in WEEKS:
        path = reg_file(tmp_path / "in", stamp, rows)
        feeds.apply_registration(spark, path, stamp, table)
        feeds.apply_registration(spark, path, stamp, plain)
        with Draft(spark, plain) as draft:
            draft.commit({}, [], sides=lambda name: not name.startswith("latest:"))
        assert states(plain) == []
    assert stored(spark, table) == stored(spark, plain) == STORED_SQL
    assert states(table) == ["latest:2024-01-15", "latest:2024-01-22"]
    state = read_side(spark, table, current_manifest(spark, table), "latest:2024-01-22")
    observed = {}
    for stamp, rows in WEEKS:
        observed |= {r["ncid"]: f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:]}" for r in rows}
    assert {(r.ncid, r.data_date.isoformat()) for r in state.collect()} == set(observed.items())
    path = reg_file(tmp_path / "in", "20240129", [registration("1", party_cd="Z"), registration("2", party_cd="A")])
    for t in (table, plain):
        assert feeds.apply_registration(spark, path, "20240129", t).inserted == 1
    assert stored(spark, table) == stored(spark, plain)
    feeds.rebuild_registration(spark, str(tmp_path / "in"), "people", table)
    assert states(table) == ["latest:2024-01-29"]
    assert feeds.apply_registration(spark, path, "20240129", table).inserted == 1


# --- late and repeated snapshots ---

def random_weeks(rng, weeks, keys="12345"):
    """Snapshots with few values, missing keys and NULL years, so that rows repeat, return and vanish."""
    out = []
    for stamp in weeks:
        rows = [registration(k, party_cd=rng.choice("AB"), birth_year=rng.choice(["1980", "1980", "1980", ""])) for k in keys if rng.random() < 0.7]
        out.append((stamp, rows or [registration(keys[0], party_cd="A")]))
    return out


@pytest.mark.parametrize("null_equality", ["sql", "null_safe"])
def test_late_and_republished_snapshots_leave_the_table_as_rebuilt(spark, tmp_path, null_equality):
    stamps = [f"202401{d:02d}" for d in (1, 8, 15, 22, 29)]
    for seed in range(3):
        rng = random.Random(seed)
        base = tmp_path / f"{seed}"
        arrivals = random_weeks(rng, rng.sample(stamps, len(stamps))) + random_weeks(rng, [rng.choice(stamps[:4])])
        table, rebuilt = str(base / "table"), str(base / "rebuilt")
        for stamp, rows in arrivals:
            path = reg_file(base / "in", stamp, rows)
            feeds.apply_registration(spark, path, stamp, table, null_equality, late="splice")
        feeds.rebuild_registration(spark, str(base / "in"), "people", rebuilt, null_equality)
        assert stored(spark, table) == stored(spark, rebuilt), (seed, [s for s, _ in arrivals])
        # what was skipped is known as if it had come in order, so the next late file is exact as well
        sides = [{n: rows_of(read_side(spark, t, m, n).select("ncid")) for n in m.sides if n.startswith("skipped:")} for t in (table, rebuilt) for m in [current_manifest(spark, t)]]
        assert {n: r for n, r in sides[0].items() if r} == {n: r for n, r in sides[1].items() if r}


def test_late_snapshot_of_a_table_that_notes_nothing_is_refused(spark, tmp_path):
    table = str(tmp_path / "table")
    for stamp, rows in WEEKS[1:3]:
        path = reg_file(tmp_path / "in", stamp, rows)
        feeds.apply_registration(spark, path, stamp, table)
    with Draft(spark, table) as draft:
        draft.commit({}, [], sides=lambda name: False)
    with pytest.raises(feeds.LateSnapshot, match="does not note"):
        feeds.apply_registration(spark, path, "20240101", table, late="splice")
    twice = reg_file(tmp_path / "twice", "20240101", [registration("1", party_cd="A"), registration("1", party_cd="B")])
    fresh = str(tmp_path / "fresh")
    feeds.apply_registration(spark, path, "20240115", fresh)
    with pytest.raises(KeyViolation):
        feeds.apply_registration(spark, twice, "20240101", fresh, late="splice")


def test_participation_published_again_adds_only_what_is_new(spark, tmp_path):
    table = str(tmp_path / "table")
    put = lambda stamp, *keys: feeds.apply_participation(spark, part_file(tmp_path / "in", stamp, [participation(k) for k in keys]), stamp, table)
    assert [put("20240101", "1", "2").inserted, put("20240108", "1", "2", "3").inserted] == [2, 1]
    again = put("20240101", "1", "4", "4")
    assert (again.staged, again.inserted) == (3, 2)
    assert put("20240101", "1", "4", "4").inserted == 0 and put("20240108", "3").inserted == 0
    assert [(r[0], r[3]) for r in logged(spark, table)] == [("1", "2024-01-01"), ("2", "2024-01-01"), ("3", "2024-01-08"), ("4", "2024-01-01"), ("4", "2024-01-01")]
    assert current_manifest(spark, table).rows == {"2024-01-01": 4, "2024-01-08": 1}


def test_index_of_stored_rows_equals_the_table(spark, tmp_path, monkeypatch):
    """With a broadcast, without one, without an index, and after the index was written anew."""
    monkeypatch.setattr(feeds, "INDEX_PARTS", 3)
    tables = {name: str(tmp_path / name) for name in ("broadcast", "shuffled", "plain")}
    for k, (stamp, rows) in enumerate([*random_log(1), *[(f"202402{d:02d}", random_log(d)[0][1]) for d in range(10, 14)]]):
        path = part_file(tmp_path / "in", stamp, rows + [participation(f"n{k}")])
        counts = set()
        for name, table in tables.items():
            monkeypatch.setattr(feeds, "BROADCAST_ROWS", 0 if name == "shuffled" else 500_000)
            counts.add(feeds.apply_participation(spark, path, stamp, table).inserted)
            manifest = current_manifest(spark, table)
            if name == "plain":
                with Draft(spark, table) as draft:
                    draft.commit({}, [], sides=lambda n: False)
            else:
                stored_fps = feeds.read_table(spark, table, schemas.PARTICIPATION_LOG, feeds._FINGERPRINT_FIELD).select("_digest").distinct()
                index = read_side(spark, table, manifest, *(f for f, _, _ in feeds._index_parts(manifest))).select("_fp")
                assert rows_of(index) == rows_of(stored_fps)
                assert len(feeds._index_parts(manifest)) <= 3
        assert len(counts) == 1
    assert logged(spark, tables["broadcast"]) == logged(spark, tables["shuffled"]) == logged(spark, tables["plain"])


def test_lots_of_a_series_store_what_one_pass_stores(spark, tmp_path, monkeypatch):
    """With filters, with large ones, and after the index was written anew; no lot holds all fingerprints."""
    whole, lots = str(tmp_path / "whole"), str(tmp_path / "lots")
    held, kept = [], feeds.work_table

    def noted(rows, purpose):
        if purpose == "fresh":
            held.append(rows.count())
        return kept(rows, purpose)

    monkeypatch.setattr(feeds, "work_table", noted)
    monkeypatch.setattr(feeds, "INDEX_PARTS", 2)
    for k, stamp in enumerate(["20240101", "20240115", "20240108"]):
        intra_batch = "dedupe" if k == 1 else "keep"
        rows = [participation(f"{n}", voting_method=m) for n in range(20 * k, 20 * k + 60) for m in ("A", "", "A")] + [participation("hot")] * 50
        path = part_file(tmp_path / "in", stamp, rows)
        with monkeypatch.context() as small:
            one = feeds.apply_participation(spark, path, stamp, whole, intra_batch)
            del held[:]
            small.setattr(feeds, "LOT_ROWS", 120)
            small.setattr(feeds, "BROADCAST_ROWS", 0 if k % 2 else 500_000)
            small.setattr(feeds, "FILTER_BLOCKS", 0 if k > 1 else 8192)
            assert feeds.apply_participation(spark, path, stamp, lots, intra_batch) == one
            assert len(held) == 2 and max(held) < sum(held)
        manifest = current_manifest(spark, lots)
        stored_fps = feeds.read_table(spark, lots, schemas.PARTICIPATION_LOG, feeds._FINGERPRINT_FIELD).select("_digest").distinct()
        assert rows_of(read_side(spark, lots, manifest, *(f for f, _, _ in feeds._index_parts(manifest))).select("_fp")) == rows_of(stored_fps)
    assert logged(spark, whole) == logged(spark, lots) and len(logged(spark, lots)) > 290
    assert current_manifest(spark, whole).rows == current_manifest(spark, lots).rows


def test_shuffle_files_go_when_a_table_has_been_written(spark, tmp_path):
    """Not only when the driver next collects its garbage."""
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    path = part_file(tmp_path / "in", "20240101", [participation(f"{k}") for k in range(50)])
    before = files()
    with feeds.work_table(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "shuffled") as found:
        assert found.count() == 7
    feeds.apply_participation(spark, path, "20240101", str(tmp_path / "table"), "dedupe")
    until = time.time() + 10
    while len(left := {f for f in files() - before if f.endswith(".data")}) > 2 and time.time() < until:
        time.sleep(0.2)
    assert len(left) <= 2  # of the small counts, which are no tables
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_stored_fingerprints_are_not_shuffled_and_only_some_buckets_read(spark, tmp_path):
    """The plan that looks up a few fingerprints: buckets by partition, the stored side streams past a broadcast."""
    table = str(tmp_path / "table")
    path = part_file(tmp_path / "in", "20240101", [participation(f"{k}") for k in range(200)])
    feeds.apply_participation(spark, path, "20240101", table)
    manifest = current_manifest(spark, table)
    stored_fps = feeds.read_table(spark, table, schemas.PARTICIPATION_LOG, feeds._FINGERPRINT_FIELD).select(F.col("_digest").alias("_fp"))
    wanted = stored_fps.limit(2).unionByName(spark.createDataFrame([("new",), ("other",)], "_fp string"))
    with feeds.known_fingerprints(spark, table, manifest, wanted) as known:
        assert known.count() == 2
        text = known._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert "PartitionFilters: [bucket" in text or "PartitionFilters: [isnotnull(bucket" in text
    parts = feeds._index_parts(manifest)
    bloom = read_side(spark, table, manifest, parts[0][1])
    probes = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("_fp"))
    false_hits = feeds.may_contain(probes, bloom, parts[0][2], "hit").where("hit").count()
    assert feeds.may_contain(stored_fps, bloom, parts[0][2], "hit").where("NOT hit").count() == 0 and false_hits < 100


# --- layouts and quality ---

def test_age_alone_stores_nothing_where_the_layout_changes(spark, tmp_path):
    folder, table, series = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "series")
    old = {"birth_age": "41", "absent_ind": "x"}
    files = [
        ("20220101", [registration(k, party_cd="A") | old for k in "12"], schemas.PREVIOUS_REGISTRATION_COLUMNS),
        ("20220301", [registration("1", party_cd="A", age_at_year_end="42"), registration("2", party_cd="X", age_at_year_end="42")], REG),
        ("20220308", [registration("1", party_cd="A", age_at_year_end="42")], REG),
        ("20230101", [registration("1", party_cd="A", age_at_year_end="43")], REG),
    ]
    for stamp, rows, columns in files:
        path = reg_file(folder, stamp, rows, columns)
        feeds.apply_registration(spark, path, stamp, table, "null_safe")
    feeds.rebuild_registration(spark, str(folder), "people", series, "null_safe")
    found = [(r[0], r[1]) for r in stored(spark, series)]
    # the age differs by its meaning only until 2023, when it differs within one layout
    assert found == [("1", "2022-01-01"), ("1", "2023-01-01"), ("2", "2022-01-01"), ("2", "2022-03-01")]
    assert stored(spark, table) == stored(spark, series)


def test_quality_counts(spark, tmp_path):
    path = reg_file(tmp_path, "20240101", [registration("1", birth_year="x"), registration("2"), registration("3", vtd_desc="X\tY")])
    with open(path, "a") as file:
        file.write("\t".join(["1", "X", "", "4"]) + "\n" + '1\t"X\t\t5\t\n')
    done = feeds.apply_registration(spark, path, "20240101", str(tmp_path / "t"), long_rows="flag")
    assert (done.staged, done.failed_values, done.long_rows, done.short_rows, done.broken_quotes) == (5, 1, 1, 2, 1)


# --- versions of a table ---

def test_readers_see_whole_versions_wherever_a_writer_stops(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "table")
    for stamp, rows in WEEKS[:2]:
        path = reg_file(tmp_path / "in", stamp, rows)
        feeds.apply_registration(spark, path, stamp, table)
    before = stored(spark, table)
    path = reg_file(tmp_path / "in", "20240115", WEEKS[2][1])
    steps = [(Draft, "write"), (Draft, "write_dated_side"), (Draft, "write_side"), (Draft, "commit")]
    for owner, name in steps:
        for late in (False, True):  # before the step, and after it
            real = getattr(owner, name)

            def stop(self, *args, _real=real, _late=late, **named):
                if _late:
                    _real(self, *args, **named)
                raise KeyboardInterrupt

            with monkeypatch.context() as m:
                m.setattr(owner, name, stop)
                m.setattr(Draft, "__exit__", lambda *_: None)  # a dead writer clears nothing
                with pytest.raises(KeyboardInterrupt):
                    feeds.apply_registration(spark, path, "20240115", table)
            after_commit = name == "commit" and late
            assert stored(spark, table) == (before if not after_commit else [r for r in STORED_SQL if r[1] <= "2024-01-15"])
    feeds.apply_registration(spark, path, "20240115", table)
    assert stored(spark, table) == [r for r in STORED_SQL if r[1] <= "2024-01-15"]
    gone = remove_old_versions(spark, table, keep=1)
    assert gone and stored(spark, table) == [r for r in STORED_SQL if r[1] <= "2024-01-15"]


def test_incomplete_manifest_is_passed_over_and_two_writers_cannot_both_commit(spark, tmp_path):
    table = str(tmp_path / "table")
    feeds.apply_registration(spark, reg_file(tmp_path / "in", *WEEKS[0]), "20240101", table)
    whole = current_manifest(spark, table)
    (tmp_path / "table" / "_manifests" / f"{whole.number + 1:08d}.json").write_text(whole.to_text()[:40])
    assert current_manifest(spark, table) == whole
    first, second = Draft(spark, table), Draft(spark, table)
    assert first.number == whole.number + 2
    first.commit({}, ["2024-01-08"])
    with pytest.raises(ConcurrentCommit):
        second.commit({}, ["2024-01-15"])
    assert current_manifest(spark, table).values == ["2024-01-01", "2024-01-08"]


# --- backups ---

def test_backup_writes_only_what_changed_and_is_verified(spark, tmp_path):
    table, folder = str(tmp_path / "table"), str(tmp_path / "backup")
    put = lambda stamp, *keys: feeds.apply_participation(spark, part_file(tmp_path / "in", stamp, [participation(k) for k in keys]), stamp, table)
    back_up = lambda: backup_table(spark, table, folder, schemas.PARTICIPATION_LOG)
    whole = lambda: rows_of(feeds.read_participations(spark, table).select(*schemas.PARTICIPATION_LOG.names))
    restored = lambda **o: rows_of(restore_backup(spark, folder, schemas.PARTICIPATION_LOG, **o).select(*schemas.PARTICIPATION_LOG.names))
    assert back_up() == [] and restored() == []
    put("20240101", "1", "2")
    put("20240108", "3")
    assert back_up() == ["2024-01-01", "2024-01-08"] and back_up() == []
    put("20240115", "4")
    put("20240108", "5")
    assert back_up() == ["2024-01-08", "2024-01-15"]
    assert restored() == whole() == restored(multiline=True) and len(whole()) == 5
    part = next((tmp_path / "backup").glob("*/data_date=2024-01-01/part-*.csv"))
    part.write_text(part.read_text().replace("IN-PERSON", "ABSENTEE", 1))
    (part.parent / f".{part.name}.crc").unlink()
    with pytest.raises(DamagedBackup, match="2024-01-01"):
        restored()
    assert len(restored(verify=False)) == 5


# --- files of a stream ---

def test_stream_reads_the_files_that_the_batch_reads(spark, tmp_path):
    folder, table, checkpoint = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")
    put = lambda name, key: write_snapshot(folder / name, [participation(key)], PART)
    put("20240101_turnout.txt", "1")
    put("20240101_old_turnout.txt", "2")
    put("20240102_turnout.zip", "3")
    import os
    os.utime(put("turnout.txt", "4"), (1704844800, 1704844800))  # 10 January 2024
    stream_participations(spark, str(folder), "turnout", table, checkpoint).awaitTermination()
    assert [(r[0], r[3]) for r in logged(spark, table)] == [("1", "2024-01-01"), ("4", "2024-01-10")]
    assert ignored_files(spark, checkpoint) == ["20240101_old_turnout.txt", "20240102_turnout.zip"]


def test_stream_reads_all_layouts_and_puts_late_files_in_their_place(spark, tmp_path):
    folder, table, checkpoint, rebuilt = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c"), str(tmp_path / "r")
    run = lambda: stream_registrations(spark, str(folder), "people", table, checkpoint).awaitTermination()
    reg_file(folder, "20240108", WEEKS[1][1], list(reversed(REG)))
    run()
    reg_file(folder, "20240101", [r | {"birth_age": r["age_at_year_end"]} for r in WEEKS[0][1]], schemas.PREVIOUS_REGISTRATION_COLUMNS)
    reg_file(folder, "20240115", WEEKS[2][1])
    run()
    feeds.rebuild_registration(spark, str(folder), "people", rebuilt)
    assert stored(spark, table) == stored(spark, rebuilt) and len(stored(spark, table)) > 5


def test_late_file_of_the_job_is_spliced_or_set_aside(spark, tmp_path):
    for late in ("splice", "skip"):
        job = pipeline(tmp_path / late)
        job.late = late
        for stamp, rows in (WEEKS[0], WEEKS[2]):
            reg_file(tmp_path / late / "in", stamp, rows)
        run_incremental(spark, job, raise_errors=True)
        reg_file(tmp_path / late / "in", *WEEKS[1])
        (tmp_path / late / "in" / "20240108_other.txt").write_text("x")
        report = run_incremental(spark, job, raise_errors=True)
        assert report.late == ["20240108_people.txt"] and report.ignored == ["20240108_other.txt"]
        assert list(report.applied) == (["20240108_people.txt"] if late == "splice" else [])
        assert (stored(spark, job.registration_table) == [r for r in STORED_SQL if r[1] <= "2024-01-15"]) == (late == "splice")
        assert not run_incremental(spark, job, raise_errors=True).late
