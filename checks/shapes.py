"""Benchmark tables seen as snapshots, logs, placeholder tables and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keys import latest_per_key
from tidemark.schemas import PLACEHOLDER_DATE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str):
    return F.col(column).cast("date")


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and day, like a registration snapshot: the day's last event, coarsened."""
    events = table(spark, sf_dir, "events").withColumn("data_date", day("ts"))
    last = latest_per_key(
        events.select("user_id", "data_date", "ts", "event_id", "event_type", "value"), ["user_id", "data_date"], "ts", ["event_id"]
    )
    return last.select(
        "user_id",
        "data_date",
        F.when(F.col("event_type") == "purchase", "P").otherwise("N").alias("segment"),
        F.when(F.col("value") < 5, None).when(F.col("value") < 100, 1).otherwise(2).cast("int").alias("bucket"),
    )


def recoded_user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User days with a code that is respelled every week under a fixed description, and an age in weeks."""
    week = F.weekofyear("data_date")
    return user_days(spark, sf_dir).select(
        "user_id",
        "data_date",
        F.concat("segment", F.when(week % 2 == 0, "X").otherwise("Y")).alias("segment_abbrv"),
        F.col("segment").alias("segment_desc"),
        F.coalesce("bucket", F.lit(0)).alias("bucket"),
        week.alias("age"),
    )


def shipping_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a log with many equal rows, batched by ship year; `note` is NULL or '' at random places."""
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
        F.round(F.col("l_tax") * 100).cast("int").alias("tax"),
        F.when(F.col("l_linenumber") <= 2, None).when(F.col("l_linenumber") <= 4, "").otherwise("late").alias("note"),
        F.year("l_shipdate").alias("batch"),
    )


LOG_COLUMNS = ["l_returnflag", "l_linestatus", "quantity", "discount", "tax", "note"]


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose date is text, with a placeholder in place of the date of very small orders."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        day("o_orderdate").alias("data_date"),
        F.when(F.col("o_totalprice") < 8000, PLACEHOLDER_DATE)
        .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
        .alias("registr_dt"),
    )


def size_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sizes spelled in the ways numbers and non-numbers occur in text files."""
    size = F.col("p_size").cast("string")
    spelled = (
        F.when(F.col("p_size") <= 4, "")
        .when(F.col("p_size") <= 8, F.concat(size, F.lit("x0")))
        .when(F.col("p_size") <= 14, F.concat(size, F.lit(".0")))
        .when(F.col("p_size") <= 20, F.concat(F.lit("+"), size))
        .when(F.col("p_size") <= 24, F.concat(size, F.lit(".5")))
        .when(F.col("p_size") <= 30, F.concat(F.lit("00"), size))
        .when(F.col("p_size") <= 34, F.concat(size, F.lit("e2")))
        .when(F.col("p_size") <= 38, F.concat(F.lit("99999999"), size))
        .otherwise(size)
    )
    return table(spark, sf_dir, "part").select("p_partkey", spelled.alias("size_text"))


def customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed file per customer; the stamp is the newest order date, unreadable for small customers."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(
        F.when(F.count(F.lit(1)) > 5, F.max(day("o_orderdate")).cast("string")).alias("timestamp")
    ).select(F.concat(F.lit("feed_"), F.col("o_custkey").cast("string"), F.lit(".txt")).alias("file_name"), "timestamp")


def customer_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger entries of the customers that have finished orders; stamps lag behind for some of them."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return orders.groupBy("o_custkey").agg(
        F.max(day("o_orderdate")).cast("string").alias("timestamp"),
        F.count(F.lit(1)).alias("n"),
        F.max(F.col("o_orderpriority")).alias("p"),
        F.min(F.col("o_orderpriority")).alias("q"),
    ).select(
        F.concat(F.lit("feed_"), F.col("o_custkey").cast("string"), F.lit(".txt")).alias("file_name"),
        "timestamp",
        F.when(F.col("n") > 3, True).when(F.col("n") > 1, False).alias("processed"),
        F.when(F.col("q") == "1-URGENT", True).when(F.col("p") == "5-LOW", False).alias("archived"),
    )
