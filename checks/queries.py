"""Spark side of the queries. Every query covers its tables completely."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import feeds
from checks.shapes import (
    LOG_COLUMNS,
    customer_files,
    customer_ledger,
    dated_orders,
    day,
    recoded_user_days,
    shipping_log,
    size_texts,
    table,
    user_days,
)
from tidemark.functions import row_fingerprint, to_date_lenient, to_int_lenient
from tidemark.operators import changes, clean, joins, keys, ledger, placeholders, profile, versions
from tidemark.plans import analyses


# --- latest rows and change detection ---

def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return keys.latest_per_key(events, ["user_id"], "ts", ["event_id"]).drop("ts")


def asof_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.as_of_view(user_days(spark, sf_dir), ["user_id"], "data_date", "2024-01-15")


def rebuild_changes_sql_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.keep_changes(user_days(spark, sf_dir), "user_id", "data_date")


def rebuild_changes_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.keep_changes(user_days(spark, sf_dir), "user_id", "data_date", "null_safe")


def _apply_newest(spark: SparkSession, sf_dir: str, null_equality: str) -> DataFrame:
    days = user_days(spark, sf_dir)
    newest = days.agg(F.max("data_date")).scalar()
    staged = days.where(F.col("data_date") == newest)
    return changes.changed_rows(staged, days, "user_id", "data_date", null_equality, as_of=newest)


def apply_snapshot_sql_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _apply_newest(spark, sf_dir, "sql")


def apply_snapshot_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _apply_newest(spark, sf_dir, "null_safe")


# --- the log: fingerprints and new rows ---

def row_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", day("o_orderdate").alias("order_date"), "o_orderpriority"
    )
    return orders.select("o_orderkey", row_fingerprint(orders.columns, ["order_date"]).alias("fingerprint"))


def _newest_batch(spark: SparkSession, sf_dir: str, intra_batch: str) -> DataFrame:
    log = shipping_log(spark, sf_dir)
    newest = log.agg(F.max("batch")).scalar()
    staged, stored = log.where(F.col("batch") == newest), log.where(F.col("batch") < newest)
    return changes.new_rows(staged, stored, LOG_COLUMNS, intra_batch)


def history_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _newest_batch(spark, sf_dir, "keep")


def history_new_rows_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _newest_batch(spark, sf_dir, "dedupe")


def history_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.first_batch_rows(shipping_log(spark, sf_dir), "batch", LOG_COLUMNS)


def history_rebuild_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.first_batch_rows(shipping_log(spark, sf_dir), "batch", LOG_COLUMNS, "dedupe")


# --- clean-up ---

def whitespace_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.normalize_whitespace(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def int_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return size_texts(spark, sf_dir).select("p_partkey", "size_text", to_int_lenient("size_text").alias("size"))


def date_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated_orders(spark, sf_dir).select("o_orderkey", to_date_lenient("registr_dt").alias("registered"))


def schema_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = T.StructType([
        T.StructField("c_mktsegment", T.StringType()),
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_phone", T.StringType()),
        T.StructField("c_name", T.StringType()),
    ])
    return clean.align_to_schema(table(spark, sf_dir, "customer"), target)


# --- placeholders ---

def placeholder_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.placeholders_by_count(dated_orders(spark, sf_dir))


def placeholder_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.placeholders_by_date(dated_orders(spark, sf_dir))


def placeholder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.placeholder_details(dated_orders(spark, sf_dir), key="o_orderkey")


def placeholder_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = analyses.placeholder_breakdown(dated_orders(spark, sf_dir), ["o_orderstatus", "o_orderpriority"])
    return shares.withColumn("pct_of_placeholder_rows", F.col("pct_of_placeholder_rows").cast("double"))


def placeholder_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = analyses.placeholder_share(dated_orders(spark, sf_dir), "o_custkey")
    return shares.withColumns({c: F.col(c).cast("double") for c in ("pct_of_group", "pct_of_placeholder_rows")})


def placeholder_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.placeholder_spikes(dated_orders(spark, sf_dir), factor=1)


def placeholder_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = dated_orders(spark, sf_dir)
    return placeholders.backfill(orders, "o_custkey", "data_date", "registr_dt", "registr_dt_filled", ["o_orderkey"])


# --- keys and duplicates ---

def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.null_keys(user_days(spark, sf_dir), ["user_id", "bucket"])


def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", day("ts").alias("day"))
    return profile.duplicate_groups(events, ["user_id", "day"])


def duplicate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", day("ts").alias("day"))
    found = profile.duplicate_profile(events, ["user_id", "day"])
    return found.withColumn("mean_rows_per_group", F.round(F.col("mean_rows_per_group"), 6))


def duplicate_profile_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that agree in five columns."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax")
    found = profile.duplicate_profile(items, items.columns)
    return found.withColumn("mean_rows_per_group", F.round(F.col("mean_rows_per_group"), 6))


# --- ledger ---

def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.pending_files(customer_files(spark, sf_dir), customer_ledger(spark, sf_dir))


def needs_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = customer_ledger(spark, sf_dir)
    return ledger.needs_backup(ledger.pending_files(customer_files(spark, sf_dir), known), known)


def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = customer_ledger(spark, sf_dir)
    updates = ledger.pending_files(customer_files(spark, sf_dir), known).select(
        "file_name", "timestamp", F.lit(True).alias("processed"), F.lit(None).cast("boolean").alias("archived")
    )
    return ledger.upsert_ledger(known, updates)


# --- reading the change history ---

def change_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = changes.keep_changes(user_days(spark, sf_dir), "user_id", "data_date")
    return versions.classify_changes(history, "user_id", "data_date", {"segment": ["segment"], "bucket": ["bucket"]})


def _coded_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = changes.keep_changes(recoded_user_days(spark, sf_dir), "user_id", "data_date", "null_safe")
    return versions.code_only_changes(
        history, "user_id", "data_date", [("segment_abbrv", "segment_desc")], increments=["age"]
    )


def code_only_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded_history(spark, sf_dir).withColumn("recoded", F.array_join("recoded", ","))


def changes_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.changes_per_key(_coded_history(spark, sf_dir), "user_id")


# --- labels ---

def label_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = profile.label_drift(table(spark, sf_dir, "orders"), "o_orderpriority", F.year("o_orderdate"))
    return drift.withColumn("pct_of_period", F.col("pct_of_period").cast("double"))


def label_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", day("o_orderdate").alias("day"))
    return profile.label_span(orders, "o_orderpriority", "day")


def latest_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", day("l_shipdate").alias("data_date"), "l_returnflag", "l_linestatus", "l_partkey"
    )
    return keys.latest_per_key(items, ["l_orderkey", "l_linenumber"], "data_date", ["l_returnflag", "l_linestatus", "l_partkey"])


def layout_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.layout_conformance(table(spark, sf_dir, "customer"), {"c_name": 18, "c_mktsegment": 9})


# --- links and codes ---

def key_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return joins.link_history(customers, table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_custkey")


def key_link_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return joins.link_history(user_days(spark, sf_dir), events, "user_id", "data_date")


def key_link_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("day", day("ts"))
    bought = events.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("day").alias("data_date"), F.col("event_id").alias("purchase_id"), "value"
    )
    others = events.where(F.col("event_type") != "purchase").select("user_id", "event_id", "event_type", "day")
    return joins.link_history_as_of(bought, others, "user_id", "data_date", "day", ties=["purchase_id"])


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").where(F.col("n_name") != "NATION_7")


def decode_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return joins.decode(customers, "c_nationkey", _nations(spark, sf_dir), "n_nationkey", "n_name", "nation")


def unknown_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.unknown_codes(table(spark, sf_dir, "customer"), "c_nationkey", _nations(spark, sf_dir), "n_nationkey")


QUERIES = {
    f.__name__: f
    for f in (
        latest_per_key, asof_view, rebuild_changes_sql_null, rebuild_changes_null_safe,
        apply_snapshot_sql_null, apply_snapshot_null_safe,
        row_fingerprints, history_new_rows, history_new_rows_dedupe, history_rebuild, history_rebuild_dedupe,
        whitespace_normalized, int_lenient, date_lenient, schema_aligned,
        placeholder_by_count, placeholder_by_date, placeholder_rows, placeholder_breakdown,
        placeholder_share, placeholder_spikes, placeholder_backfill,
        key_violations, null_keys, duplicate_groups, duplicate_profile, duplicate_profile_wide,
        pending_files, needs_backup, ledger_upsert,
        change_classification, code_only_changes, changes_per_key,
        label_drift, label_span, latest_label, layout_conformance,
        key_link, key_link_latest, key_link_asof, decode_codes, unknown_codes,
        feeds.snapshot_scan, feeds.backup_restore, feeds.registration_rebuild_files, feeds.registration_stream,
        feeds.registration_incremental, feeds.participation_rebuild_files, feeds.participation_stream,
        feeds.prepared_csv, feeds.appended_rows, feeds.table_columns, feeds.code_names, feeds.ledger_scan, feeds.http_dates,
        feeds.layout_widths, feeds.registration_late, feeds.registration_layouts, feeds.registration_report, feeds.quality_counts,
        feeds.participation_incremental, feeds.participation_backup, feeds.log_versions,
    )
}
