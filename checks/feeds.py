"""Queries that go through files: the tables are written as snapshot files, then read by the jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.shapes import customer_ledger, dated_orders, table, user_days
from tidemark import schemas
from tidemark.functions import to_date_lenient
from tidemark.functions.digest import date_columns_of
from tidemark.operators.joins import decode
from tidemark.operators.profile import layout_conformance
from tidemark.plans import feeds
from tidemark.plans.incremental import Pipeline, run_incremental
from tidemark.schemas import PARTICIPATION_COLUMNS, REGISTRATION_COLUMNS
from tidemark.session import shuffles_dropped, work_folder
from tidemark.sinks.backups import backup_table, restore_backup
from tidemark.sinks.tables import append_master, create_table, export_tsv
from tidemark.sources.files import move_file, part_files, remove_folder
from tidemark.sources.ledger import read_ledger, read_ledger_document, write_ledger
from tidemark.sources.manifest import current_manifest
from tidemark.sources.snapshots import http_date, list_snapshots, read_snapshot
from tidemark.sources.tables import code_list, columns_of, import_csv, import_tsv, read_table
from tidemark.streaming.snapshots import stream_participations, stream_registrations


def land(spark: SparkSession, rows: DataFrame, stamp: Column, stem: str, folder: str | None = None) -> str:
    """Write rows as dated snapshot files `YYYYMMDD_<stem>...txt` in a folder, by default a new one; returns it."""
    raw, folder = work_folder(spark, "raw"), folder or work_folder(spark, "landing")
    with shuffles_dropped(spark):
        (
            rows.withColumn("stamp", stamp).drop("data_date", "stamp_text").hint("rebalance", "stamp")
            .write.partitionBy("stamp")
            .options(sep="\t", header=True, quote='"', escape='"', encoding="ISO-8859-1", emptyValue="")
            .csv(raw)
        )
    for path in part_files(spark, raw):
        date = path.split("stamp=")[1][:8]
        move_file(spark, path, f"{folder}/{date}_{stem}.{uuid.uuid4().hex}.txt")
    remove_folder(spark, raw)
    return folder


def _registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User days in the columns of a registration file; an unknown bucket is an empty birth year."""
    days = user_days(spark, sf_dir)
    known = {
        "ncid": F.col("user_id").cast("string"),
        "party_cd": F.col("segment"),
        "birth_year": F.coalesce((F.col("bucket") + 1980).cast("string"), F.lit("")),
        "age_at_year_end": F.lit("44"),
        "last_name": F.concat(F.lit("  name  "), F.col("user_id").cast("string")),
    }
    return days.select("data_date", *[known.get(c, F.lit("")).alias(c) for c in REGISTRATION_COLUMNS])


def _stamp(date: str = "data_date") -> Column:
    return F.date_format(date, "yyyyMMdd")


def _registration_rows(df: DataFrame) -> DataFrame:
    return df.select("ncid", "data_date", "party_cd", "birth_year", "last_name")


def _job(spark: SparkSession, folder: str) -> Pipeline:
    base = work_folder(spark, "job")
    return Pipeline(
        landing=folder, registration_stem="people", participation_stem="turnout",
        registration_table=f"{base}/registrations", participation_table=f"{base}/participations",
        backup_folder=f"{base}/backup", ledger=f"{base}/ledger",
    )


def _run(spark: SparkSession, pipeline: Pipeline) -> None:
    """Run the job until nothing is left, which must be after one run."""
    first = run_incremental(spark, pipeline, raise_errors=True)
    second = run_incremental(spark, pipeline, raise_errors=True)
    if not first.applied or second.applied:
        raise AssertionError("the second run must find nothing to do")


# --- scans, imports and backups ---

def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as one snapshot file folder and scanned back as text."""
    path = work_folder(spark, "scan")
    rows = dated_orders(spark, sf_dir).select(*[F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderpriority", "registr_dt")])
    rows.write.options(sep="\t", header=True, quote='"', escape='"').csv(path)
    scan = read_snapshot(spark, path)
    return scan.withColumn("registered", to_date_lenient("registr_dt"))


def backup_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and orders' placeholder text exported as a backup and restored; NULL and '' survive."""
    path = work_folder(spark, "backup")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.when(F.col("lang") == "en", "").when(F.col("lang") != "de", F.col("lang")).alias("lang"), "n_chars"
    )
    export_tsv(rows, path)
    return import_tsv(spark, path, rows.schema, multiline=True)


def prepared_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a prepared comma-separated file, read in the target schema."""
    path = work_folder(spark, "prepared")
    customers = table(spark, sf_dir, "customer")
    customers.write.options(header=True, quote='"', escape='"').csv(path)
    return import_csv(spark, path, customers.schema)


def appended_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of each status appended to one table, one date per order month; read through a name in the catalog."""
    path, name = work_folder(spark, "appended"), f"appended_{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.trunc("o_orderdate", "month").alias("data_date")
    )
    for status in ("F", "O", "P"):
        append_master(orders.where(F.col("o_orderstatus") == status), path, orders.columns)
    create_table(spark, name, path, orders.schema)
    return spark.table(name)


def table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names of a stored table in order, and which of them are dates."""
    orders = table(spark, sf_dir, "orders").withColumn("data_date", F.trunc("o_orderdate", "year"))
    path = work_folder(spark, "columns")
    append_master(orders, path, orders.columns)
    stored = read_table(spark, path, orders.schema)
    dates = set(date_columns_of(stored))
    first = stored.groupBy().agg(*[F.count(F.col(c)).alias(c) for c in columns_of(stored)])
    listed = F.array(*[F.struct(F.lit(k).alias("position"), F.lit(c).alias("name"), F.lit(c in dates).alias("is_date"), F.col(c).alias("n_values")) for k, c in enumerate(columns_of(stored))])
    return first.select(F.explode(listed).alias("c")).select("c.*")


def code_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations as a code list, with the names of customers' codes."""
    nations = {str(r["n_nationkey"]): r["n_name"] for r in table(spark, sf_dir, "nation").collect()}  # 25 rows
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("code"))
    return decode(customers, "code", code_list(spark, nations, "n_code", "n_name"), "n_code", "n_name", "nation")


def ledger_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers' ledger as one JSON object with entries of both forms, brought into the stored ledger and updated."""
    known = customer_ledger(spark, sf_dir)
    path, stored = work_folder(spark, "ledger-document"), work_folder(spark, "ledger")
    bare = F.col("processed").isNull() & F.col("file_name").contains("9.txt")
    entry = F.when(bare, F.concat(F.lit('"'), F.col("timestamp"), F.lit('"'))).otherwise(F.to_json(F.struct("timestamp", "processed", "archived")))
    pairs = known.agg(F.array_join(F.collect_list(F.concat(F.lit('"'), F.col("file_name"), F.lit('":'), entry)), ",").alias("pairs"))
    pairs.select(F.concat(F.lit("{"), "pairs", F.lit("}"))).write.text(path)  # one document, as the format demands
    write_ledger(spark, stored, read_ledger_document(spark, path))
    write_ledger(spark, stored, read_ledger(spark, stored).where("NOT processed").withColumns({"processed": F.lit(True), "archived": F.lit(None).cast("boolean")}))
    return read_ledger(spark, stored)


def http_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as HTTP date text, as the ledger compares them."""
    here = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts").cast("timestamp_ntz")).cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", http_date(here).alias("stamp"))


# --- registrations ---

def registration_rebuild_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily registration files rebuilt into a change history."""
    folder = land(spark, _registrations(spark, sf_dir), _stamp(), "people")
    registrations = work_folder(spark, "registrations")
    feeds.rebuild_registration(spark, folder, "people", registrations)
    return _registration_rows(feeds.read_registrations(spark, registrations))


def registration_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files consumed as a stream, comparing NULL as equal."""
    rows = _registrations(spark, sf_dir)
    folder = land(spark, rows, _stamp(), "people")
    registrations, checkpoint = work_folder(spark, "registrations"), work_folder(spark, "stream")
    stream_registrations(spark, folder, "people", registrations, checkpoint, "null_safe").awaitTermination()
    return _registration_rows(feeds.read_registrations(spark, registrations))


def registration_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All daily files of people, with the files of turnout beside them, handed to the recurring job."""
    folder = land(spark, _registrations(spark, sf_dir), _stamp(), "people")
    land(spark, _participations(spark, sf_dir), F.col("stamp_text"), "turnout", folder)
    pipeline = _job(spark, folder)
    _run(spark, pipeline)
    return _registration_rows(feeds.read_registrations(spark, pipeline.registration_table))


def registration_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily files that come in three lots: every third day, then the two thirds between them, the later third first."""
    rows = _registrations(spark, sf_dir)
    third = F.datediff("data_date", F.lit("2020-01-06").cast("date")) % 9
    folder, pipeline = work_folder(spark, "landing"), None
    for lot in (third >= 3, (third >= 1) & (third < 3), third < 1):
        land(spark, rows.where(lot), _stamp(), "people", folder)
        pipeline = pipeline or _job(spark, folder)
        _run(spark, pipeline)
    return _registration_rows(feeds.read_registrations(spark, pipeline.registration_table))


def registration_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily files, in the previous layout up to the middle of the month: at the switch the age alone stores nothing."""
    rows = _registrations(spark, sf_dir).withColumn("age_at_year_end", F.when(F.dayofmonth("data_date") <= 15, "44").otherwise("45"))
    folder = work_folder(spark, "landing")
    before = rows.where(F.dayofmonth("data_date") <= 15).withColumnRenamed("age_at_year_end", "birth_age")
    land(spark, before, _stamp(), "people", folder)
    land(spark, rows.where(F.dayofmonth("data_date") > 15), _stamp(), "people", folder)
    registrations = work_folder(spark, "registrations")
    feeds.rebuild_registration(spark, folder, "people", registrations, "null_safe")
    return _registration_rows(feeds.read_registrations(spark, registrations)).drop("birth_year")


def layout_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text column of the registration files against its declared width."""
    rows = _registrations(spark, sf_dir)
    return layout_conformance(rows, {c: w for c, w in schemas.REGISTRATION_WIDTHS.items() if c in REGISTRATION_COLUMNS})


def registration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job reports for each daily file: rows read and stored, values that did not parse, short rows."""
    rows = _registrations(spark, sf_dir).withColumn("age_at_year_end", F.when(F.col("party_cd") == "P", "old").otherwise("44"))
    pipeline = _job(spark, land(spark, rows, _stamp(), "people"))
    report = run_incremental(spark, pipeline, raise_errors=True)
    days = [(a.snapshot_date, a.staged, a.inserted, a.failed_values, a.short_rows, a.long_rows) for a in report.applied.values()]  # one row a file
    return spark.createDataFrame(days, "stamp string, staged long, inserted long, failed_values long, short_rows long, long_rows long")


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a file with long, short and broken rows, counted per date in one pass."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    line = F.concat_ws("\t", key.cast("string"), F.col("o_orderpriority"), F.date_format("o_orderdate", "MM/dd/yyyy"))
    kind = key % 11
    spoiled = (
        F.when(kind == 1, F.concat(line, F.lit("\tmore")))
        .when(kind == 2, F.concat_ws("\t", key.cast("string"), F.col("o_orderpriority")))
        .when(kind == 3, F.concat(key.cast("string"), F.lit('\t"'), F.col("o_orderpriority")))
        .otherwise(line)
    )
    path, folder = work_folder(spark, "lines"), work_folder(spark, "landing")
    header = spark.createDataFrame([("ncid\tvoting_method\telection_lbl",)], "value string")
    spoiled_rows = orders.select(F.date_format(F.trunc("o_orderdate", "year"), "yyyyMMdd").alias("stamp"), spoiled.alias("value"))
    spoiled_rows.hint("rebalance", "stamp").write.partitionBy("stamp").text(path)
    for part in part_files(spark, path):
        stamp = part.split("stamp=")[1][:8]
        lines = header.unionByName(spark.read.text(part).select("value"))
        own = f"{folder}/_{uuid.uuid4().hex}"
        lines.coalesce(1).write.text(own)
        move_file(spark, part_files(spark, own)[0], f"{folder}/{stamp}_turnout.{uuid.uuid4().hex}.txt")
    paths = {f["path"]: f["stamp"] for f in list_snapshots(spark, folder, "turnout").collect()}
    rows = feeds.read_dated_snapshots(spark, paths, feeds.prepare_participation, quality=True, long_rows="flag")
    return feeds.quality_counts(rows)


# --- participations ---

def _participations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the columns of a participation file, one snapshot per ship year; one person for each part."""
    items = table(spark, sf_dir, "lineitem")
    known = {
        "ncid": F.col("l_partkey").cast("string"),
        "election_lbl": F.concat(F.col("l_linenumber").cast("string"), F.lit("/3/2000")),
        "voting_method": F.col("l_returnflag"),
        "voted_party_cd": F.col("l_linestatus"),
    }
    return items.select(
        F.concat(F.year("l_shipdate").cast("string"), F.lit("1231")).alias("stamp_text"),
        *[known.get(c, F.lit("")).alias(c) for c in PARTICIPATION_COLUMNS],
    )


def _participation_rows(df: DataFrame) -> DataFrame:
    return df.select("ncid", "election_lbl", "voting_method", "voted_party_cd", "data_date")


def _land_participations(spark: SparkSession, sf_dir: str) -> str:
    return land(spark, _participations(spark, sf_dir), F.col("stamp_text"), "turnout")


def participation_rebuild_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly participation files rebuilt into the log, with all copies of a row."""
    folder, log = _land_participations(spark, sf_dir), work_folder(spark, "participations")
    feeds.rebuild(spark, folder, {"participation": ("turnout", log)}, {"participation"})
    return _participation_rows(feeds.read_participations(spark, log))


def participation_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files consumed as a stream, keeping one row of equal ones."""
    folder, log = _land_participations(spark, sf_dir), work_folder(spark, "participations")
    stream_participations(spark, folder, "turnout", log, work_folder(spark, "stream"), "dedupe").awaitTermination()
    return _participation_rows(feeds.read_participations(spark, log))


def participation_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly files applied one after the other, then the first year once more with the rows of all years: only those
    that no year had stored yet are added, which are none, and one new person's."""
    rows, log = _participations(spark, sf_dir), work_folder(spark, "participations")
    stamps = sorted(r[0] for r in rows.select("stamp_text").distinct().collect())  # one row a year
    for stamp in stamps:
        feeds.apply_participation(spark, rows.where(F.col("stamp_text") == stamp).drop("stamp_text"), stamp, log)
    again = rows.unionByName(rows.where(F.col("stamp_text") == stamps[0]).withColumn("ncid", F.concat(F.lit("new "), "ncid")))
    done = feeds.apply_participation(spark, again.drop("stamp_text"), stamps[0], log)
    if done.inserted != current_manifest(spark, log).rows[f"{stamps[0][:4]}-12-31"] // 2:
        raise AssertionError(f"{done.inserted} rows were added")
    return _participation_rows(feeds.read_participations(spark, log))


def participation_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log backed up after the first year and after the last; the second backup writes only the later years."""
    rows = _participations(spark, sf_dir)
    log, folder = work_folder(spark, "participations"), work_folder(spark, "backup")
    stamps = sorted(r[0] for r in rows.select("stamp_text").distinct().collect())  # one row a year
    for lot in (stamps[:1], stamps[1:]):
        path = land(spark, rows.where(F.col("stamp_text").isin(lot)), F.col("stamp_text"), "turnout")
        staged = feeds.read_dated_snapshots(spark, [f["path"] for f in list_snapshots(spark, path, "turnout").collect()], feeds.prepare_participation, quality=True)
        feeds.apply_participations(spark, staged, log)
        exported = backup_table(spark, log, folder, schemas.PARTICIPATION_LOG)
        if exported != [f"{s[:4]}-12-31" for s in lot]:
            raise AssertionError(f"{exported} were exported")
    return _participation_rows(restore_backup(spark, folder, schemas.PARTICIPATION_LOG))


def log_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per date as the log's manifest has them after each year was applied twice."""
    rows, log = _participations(spark, sf_dir), work_folder(spark, "participations")
    path = land(spark, rows, F.col("stamp_text"), "turnout")
    files = [f["path"] for f in list_snapshots(spark, path, "turnout").collect()]
    for _ in range(2):
        feeds.apply_participations(spark, feeds.read_dated_snapshots(spark, files, feeds.prepare_participation, quality=True), log, "dedupe")
    found = current_manifest(spark, log)
    return spark.createDataFrame(sorted(found.rows.items()), T.StructType.fromDDL("day string, n_rows long"))  # one row a date
