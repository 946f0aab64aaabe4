import datetime as dt
import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows_of, write_snapshot
from tidemark import schemas
from tidemark.operators.ledger import needs_backup, pending_files, upsert_ledger
from tidemark.sinks.tables import append_master, create_table, export_tsv, publish_partition, publish_series
from tidemark.sources.files import partition_values, recover_folder
from tidemark.sources.manifest import stored_values
from tidemark.sources.ledger import read_ledger, read_ledger_document, write_ledger
from tidemark.sources.snapshots import header_catalogue, header_of, headers_of, list_snapshots, read_snapshot
from tidemark.sources.tables import columns_of, date_columns_of, dim_ethnicity, dim_race, dim_status, import_csv, import_tsv, read_table


def snapshot(tmp_path, data: bytes, name="20240101_feed.txt"):
    path = tmp_path / name
    path.write_bytes(data)
    return str(path)


def test_scan_keeps_text_as_it_is(spark, tmp_path):
    path = snapshot(tmp_path, b'a\tb\tc\n1\t\t"x"\n""\t2\t3\n1\t2\n\nq"q\t"d""d"\tback\\slash\nNA\t\xe9\xa0 x \t"tab\there"\nnull\tNone\t00\n')
    assert read_snapshot(spark, path).collect() == [
        Row(a="1", b="", c="x"), Row(a="", b="2", c="3"), Row(a="1", b="2", c=""), Row(a='q"q', b='d"d', c="back\\slash"),
        Row(a="NA", b="\xe9\xa0 x ", c="tab\there"), Row(a="null", b="None", c="00"),
    ]


def test_long_row_fails_or_is_flagged(spark, tmp_path):
    path = snapshot(tmp_path, b'a\tb\n1\t2\n1\t2\t3\nshort\n"x\ty"\n')
    with pytest.raises(Exception, match="row with too many fields"):
        read_snapshot(spark, path).collect()
    flagged = read_snapshot(spark, path, long_rows="flag")
    assert [(r.a, r._long_row) for r in flagged.collect()] == [("1", False), ("1", True), ("short", False), ("x\ty", False)]
    with pytest.raises(ValueError):
        read_snapshot(spark, path, long_rows="ignore")


def test_long_row_fails_whatever_columns_are_read(spark, tmp_path):
    path = snapshot(tmp_path, b'a\tb\n1\t2\n1\t2\t3\n')
    for use in (lambda df: df.select("a").collect(), lambda df: df.count(), lambda df: df.where("b = '2'").select("a").collect()):
        with pytest.raises(Exception, match="row with too many fields"):
            use(read_snapshot(spark, path))


def test_files_of_one_scan_must_share_a_header(spark, tmp_path):
    paths = [snapshot(tmp_path, b"a\tb\n1\t2\n", "x.txt"), snapshot(tmp_path, b"b\ta\n1\t2\n", "y.txt")]
    with pytest.raises(ValueError, match="different headers"):
        read_snapshot(spark, paths)
    assert read_snapshot(spark, [paths[0], snapshot(tmp_path, b"a\tb\n3\t4\n", "z.txt")]).count() == 2


def test_compressed_file(spark, tmp_path):
    import gzip

    path = snapshot(tmp_path, gzip.compress("a\tb\n\xe9\t2\n".encode("latin-1")), "20240101_feed.txt.gz")
    assert read_snapshot(spark, path).collect() == [Row(a="\xe9", b="2")]
    assert [r.stem for r in list_snapshots(spark, str(tmp_path), "feed").collect()] == ["feed"]


def test_quoted_line_break_needs_multiline(spark, tmp_path):
    path = snapshot(tmp_path, b'a\tb\n"two\nlines"\tx\n')
    assert read_snapshot(spark, path, multiline=True).collect() == [Row(a="two\nlines", b="x")]


def test_quoted_line_breaks_are_found_by_many_tasks(spark, tmp_path):
    import random

    rng = random.Random(3)
    pieces = ['plain', 'q"q', '"two\nlines"', '"a ""quoted""\n\nword"', '"tab\there"', '""', '"x\n"', "", '"\n"', '5" disk', '"end"']
    for n in range(4):
        lines = ["\t".join(rng.choice(pieces) for _ in range(3)) for _ in range(400)]
        if n == 1:
            lines[100] = "k\t" + '"' + "long\n" * 900 + '"' + "\tz"  # longer than several splits
        path = snapshot(tmp_path, ("a\tb\tc\n" + "\n".join(lines) + "\n").encode("latin-1"), f"2024010{n + 1}_feed.txt")
    plain = spark.read.schema("a string, b string, c string").options(sep="\t", header=True, quote='"', escape='"', multiLine=True, encoding="ISO-8859-1").csv(str(tmp_path))
    want = rows_of(plain.na.fill(""))
    assert len(want) == 1600
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000", "300", "100m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            paths = [str(p) for p in sorted(tmp_path.glob("*.txt"))]
            assert rows_of(read_snapshot(spark, paths, multiline=True)) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    stamped = read_snapshot(spark, path, multiline=True, stamp_column="s")
    assert {r.s for r in stamped.select("s").distinct().collect()} == {"20240104"}


def test_headers_of_many_files(spark, tmp_path):
    import gzip

    paths = [snapshot(tmp_path, f"a{n % 3}\tb\r\n1\t2\n".encode(), f"{n}.txt") for n in range(998)]
    paths.append(snapshot(tmp_path, gzip.compress(b'"a0"\tb\n'), "z.txt.gz"))
    paths.append("file:" + snapshot(tmp_path, ("x" * 200_000 + "\t\xe9").encode("latin-1"), "wide.txt"))
    want = {p: (f"a{n % 3}", "b") for n, p in enumerate(paths[:998])} | {paths[998]: ("a0", "b"), paths[999]: ("x" * 200_000, "\xe9")}
    assert headers_of(spark, paths) == want
    assert headers_of(spark, paths[-60:]) == {p: want[p] for p in paths[-60:]}
    assert header_catalogue(spark, paths).select("layout").distinct().count() == 4
    with pytest.raises(ValueError, match="no header"):
        headers_of(spark, [*paths, snapshot(tmp_path, b"", "empty.txt")])


def test_windows_line_ends_and_header(spark, tmp_path):
    path = snapshot(tmp_path, b'"a"\tb\r\n1\t2\r\n')
    assert header_of(spark, path) == ["a", "b"]
    assert read_snapshot(spark, path).collect() == [Row(a="1", b="2")]


def test_listing_is_dated_sorted_and_filtered(spark, tmp_path):
    for name in ("20240108_feed.txt", "20240101_feed.txt", "feed.txt", "20240101_other.txt", "20240101_other.zip"):
        (tmp_path / name).write_text("a\n1\n")
    found = list_snapshots(spark, str(tmp_path), "feed").collect()
    assert [(r.file_name, r.stem, r.stamp, r.snapshot_date) for r in found] == [
        ("feed.txt", "feed", None, None),
        ("20240101_feed.txt", "feed", "20240101", dt.date(2024, 1, 1)),
        ("20240108_feed.txt", "feed", "20240108", dt.date(2024, 1, 8)),
    ]
    stamp = dt.datetime.strptime(found[0].timestamp, "%a, %d %b %Y %H:%M:%S GMT")
    assert abs(stamp - dt.datetime.fromtimestamp((tmp_path / "feed.txt").stat().st_mtime, dt.UTC).replace(tzinfo=None)) < dt.timedelta(seconds=2)
    assert list_snapshots(spark, str(tmp_path), "nothing").count() == 0


def test_backup_round_trip(spark, tmp_path):
    schema = T.StructType.fromDDL("s string, t string, n int, d date")
    rows = [
        (None, "", 1, None), ("", None, None, dt.date(2024, 1, 31)), ("tab\there", 'quo"te', 2, None), (" blanks ", "\\N", 3, None),
        ('"', "''", 4, None), ("\xe9中", "NULL", 5, None), ("#x", "a,b", 6, None), ("line\nbreak", "\\", 7, None), (None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "backup")
    export_tsv(df, path)
    assert rows_of(import_tsv(spark, path, schema, multiline=True)) == sorted(rows, key=repr)
    export_tsv(df.limit(1), path)  # a later backup replaces the earlier one
    assert import_tsv(spark, path, schema, multiline=True).count() == 1


def test_failed_export_leaves_the_backup_and_an_interrupted_swap_is_finished(spark, tmp_path):
    path, schema = str(tmp_path / "backup"), T.StructType.fromDDL("s string")
    rows = lambda *texts: spark.createDataFrame([(t,) for t in texts], schema)
    export_tsv(rows("a", "b"), path)
    failing = rows("c").select(F.raise_error(F.col("s")).cast("string").alias("s"))
    with pytest.raises(Exception):
        export_tsv(failing, path)
    assert rows_of(import_tsv(spark, path, schema)) == [("a",), ("b",)]
    assert [p.name for p in tmp_path.iterdir()] == ["backup"]
    # the old folder was moved aside, then the writer died
    (tmp_path / "backup").rename(tmp_path / "_old-backup")
    assert recover_folder(spark, path) and not recover_folder(spark, path)
    assert rows_of(import_tsv(spark, path, schema)) == [("a",), ("b",)]
    # the new folder was in place already
    export_tsv(rows("z"), str(tmp_path / "_old-backup"))
    assert not recover_folder(spark, path) and not (tmp_path / "_old-backup").exists()


def test_prepared_csv(spark, tmp_path):
    schema = T.StructType.fromDDL("s string, n int, d date")
    (tmp_path / "a.csv").write_text('s,n,d\n"a,""b""",1,2024-01-31\n"",,\n')
    assert import_csv(spark, str(tmp_path / "a.csv"), schema).collect() == [
        Row(s='a,"b"', n=1, d=dt.date(2024, 1, 31)), Row(s="", n=None, d=None),
    ]
    (tmp_path / "b.csv").write_text("s,n,d\nx,not a number,2024-01-31\n")
    with pytest.raises(Exception):
        import_csv(spark, str(tmp_path / "b.csv"), schema).collect()


def test_schema_introspection(spark):
    empty = spark.createDataFrame([], schemas.PARTICIPATION_TABLE)
    assert columns_of(empty) == schemas.PARTICIPATION_COLUMNS
    assert date_columns_of(empty) == ["election_lbl"]
    assert date_columns_of(spark.createDataFrame([], schemas.REGISTRATION_TABLE)) == ["data_date"]


def test_code_lists(spark):
    assert (dim_status(spark).count(), dim_race(spark).count(), dim_ethnicity(spark).count()) == (5, 8, 3)


# --- ledger ---

def test_ledger_document_forms(spark, tmp_path):
    path = tmp_path / "state.json"
    path.write_text(json.dumps({
        "a.zip": {"timestamp": "T1", "processed": False, "archived": True}, "b.zip": "T2", "c.zip": {"timestamp": "T3"},
    }, indent=2))
    assert rows_of(read_ledger_document(spark, str(path))) == [
        ("a.zip", "T1", False, True), ("b.zip", "T2", True, None), ("c.zip", "T3", True, None),
    ]
    path.write_text("{broken")
    assert read_ledger_document(spark, str(path)).count() == 0
    assert read_ledger_document(spark, str(tmp_path / "missing.json")).count() == 0


def entries(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.LEDGER)


def test_ledger_store(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert read_ledger(spark, path).count() == 0
    write_ledger(spark, path, entries(spark, ("a", "T1", False, True), ("b", "T1", None, None)))
    write_ledger(spark, path, entries(spark, ("a", "T2", True, None)))
    assert rows_of(read_ledger(spark, path)) == [("a", "T2", True, True), ("b", "T1", True, None)]
    (tmp_path / "ledger" / "part-broken.txt").write_text("{not json\n")
    assert read_ledger(spark, path).count() == 2


def test_pending_rules(spark):
    ledger = entries(spark, ("done", "T1", True, True), ("open", "T1", False, True), ("old", "T0", True, True), ("legacy", "T1", None, None))
    listing = spark.createDataFrame(
        [("done", "T1"), ("open", "T1"), ("old", "T1"), ("legacy", "T1"), ("unseen", "T1"), ("unreadable", None)], "file_name string, timestamp string"
    )
    pending = pending_files(listing, ledger)
    assert [r.file_name for r in pending.orderBy("file_name").collect()] == ["old", "open", "unseen"]
    backup = lambda name: needs_backup(pending.where(f"file_name = '{name}'"), ledger).first()[0]
    assert [backup(n) for n in ("old", "open", "unseen", "none")] == [True, False, True, False]
    assert needs_backup(listing.where("file_name = 'legacy'"), ledger).first()[0]


def test_ledger_upsert(spark):
    ledger = entries(spark, ("a", "T1", True, True), ("b", "T1", True, None))
    updates = entries(spark, ("a", "T2", False, None), ("c", "T2", True, False))
    assert rows_of(upsert_ledger(ledger, updates)) == [("a", "T2", False, True), ("b", "T1", True, None), ("c", "T2", True, False)]


# --- table partitions ---

TABLE = T.StructType([T.StructField("k", T.StringType()), T.StructField("data_date", T.DateType())])


def test_partitions_are_replaced_also_by_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = lambda *keys: spark.createDataFrame([(k, dt.date(2024, 1, 1)) for k in keys], TABLE)
    assert read_table(spark, path, TABLE).count() == 0
    publish_partition(spark, rows("a", "b"), path, "2024-01-01")
    publish_partition(spark, rows("c"), path, "2024-01-02")
    publish_partition(spark, rows(), path, "2024-01-01")
    assert rows_of(read_table(spark, path, TABLE)) == [("c", dt.date(2024, 1, 2))]
    assert stored_values(spark, path) == ["2024-01-01", "2024-01-02"]


def test_failed_check_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "table")

    def refuse(_):
        raise ValueError("no")

    with pytest.raises(ValueError):
        publish_partition(spark, spark.createDataFrame([("a", dt.date(2024, 1, 1))], TABLE), path, "2024-01-01", refuse)
    assert stored_values(spark, path) == []
    assert not [p for p in (tmp_path / "table").iterdir() if p.name.startswith("version=")]


def test_series_and_append(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 2))], TABLE)
    publish_series(spark, rows, path, ["2024-01-01", "2024-01-02", "2024-01-03"])
    append_master(rows, path, ["k", "data_date"])
    assert stored_values(spark, path) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert read_table(spark, path, TABLE).count() == 4
    assert rows_of(read_table(spark, path, TABLE, values=["2024-01-02"])) == [("b", dt.date(2024, 1, 2))] * 2
    # a plain partitioned folder is a table too, and can be extended
    plain = str(tmp_path / "plain")
    rows.write.partitionBy("data_date").parquet(plain)
    assert partition_values(spark, plain, "data_date") == stored_values(spark, plain) == ["2024-01-01", "2024-01-02"]
    append_master(rows, plain, ["k", "data_date"])
    publish_partition(spark, rows.limit(0), plain, "2024-01-01")
    assert rows_of(read_table(spark, plain, TABLE)) == [("b", dt.date(2024, 1, 2))] * 2


def test_catalog_table(spark, tmp_path):
    path = str(tmp_path / "table")
    append_master(spark.createDataFrame([("a", dt.date(2024, 1, 1))], TABLE), path, TABLE.names)
    create_table(spark, "tidemark_catalog_test", path, TABLE)
    assert spark.table("tidemark_catalog_test").count() == 1
    spark.sql("DROP VIEW tidemark_catalog_test")
