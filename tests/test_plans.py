"""The shape of physical plans: what is read, what is shuffled, what can be split."""

import re

import pytest
from conftest import write_snapshot
from pyspark.sql import functions as F

from checks.queries import QUERIES
from tidemark.operators.clean import normalize_whitespace
from tidemark.operators.joins import split_join
from tidemark.operators.keys import as_of_view, latest_per_key
from tidemark.operators.placeholders import placeholder_rows
from tidemark.plans import feeds
from tidemark.schemas import PARTICIPATION_COLUMNS, REGISTRATION_COLUMNS
from tidemark.sources.snapshots import read_dated_snapshots

SF = "/root/testdata/sf0.001"
LAZY = [n for n, query in QUERIES.items() if query.__module__ != "checks.feeds"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_query_needs_python_rows_or_products(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "ExistingRDD"):
        assert word not in text


@pytest.mark.parametrize("name", LAZY)
def test_windows_are_always_partitioned(spark, name):
    """A window over everything would order all rows in one task."""
    for line in plan(QUERIES[name](spark, SF)).splitlines():
        if " Window [" in line:
            assert not line.rstrip().endswith("[]") and "Exchange SinglePartition" not in line
            assert "], [" in line


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).select(
        F.col("id").cast("string").alias("k"), F.lit("##/##/####").alias("r"), F.lit("wide").alias("w"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("data_date"),
    )
    rows.write.partitionBy("data_date").parquet(path)
    table = spark.read.parquet(path)
    text = plan(placeholder_rows(table, "r").groupBy("data_date").count())
    assert "EqualTo(r,##/##/####)" in text and "ReadSchema: struct<r:string>" in text
    text = plan(as_of_view(table.select("k", "data_date"), ["k"], "data_date", "2024-01-03"))
    assert "PartitionFilters: [isnotnull(data_date" in text and "ReadSchema: struct<k:string>" in text


def test_latest_reduces_before_the_shuffle(spark):
    text = plan(latest_per_key(spark.read.parquet(f"{SF}/events.parquet"), ["user_id"], "ts"))
    assert text.index("Exchange hashpartitioning") < text.index("partial_max_by")


def test_hot_key_is_split_and_rows_stay_whole(spark):
    """A key with a third of all rows, against an aggregated side: the final plan cuts its partition up."""
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    unique = rows.groupBy("k").agg(F.min("v").alias("m"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for how, expected in (("inner", 300_000), ("left_semi", 300_000), ("left_anti", 0)):
            joined = split_join(rows, unique, ["k"], how)
            assert joined.count() == expected
            joined.collect() if expected == 0 else joined.write.format("noop").mode("overwrite").save()
            query = joined.groupBy().agg(F.count(F.lit(1)), F.max("v"))
            query.collect()
            assert "isSkew=true" in plan(query) or "skew=true" in plan(query), how
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("columns, prepare", [(PARTICIPATION_COLUMNS, feeds.prepare_participation), (REGISTRATION_COLUMNS, feeds.prepare_registration)])
def test_generated_code_of_staging_is_compiled(spark, tmp_path, capsys, columns, prepare):
    """The JVM only interprets a method of more than 8,000 bytes."""
    path = write_snapshot(tmp_path / "20240101_feed.txt", [dict.fromkeys(columns, " a  b ")], columns)
    rows = read_dated_snapshots(spark, [path], prepare, quality=True)
    normalize_whitespace(spark.read.schema(", ".join(f"`{c}` string" for c in columns)).option("sep", "\t").csv(path)).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert all(n < 8000 for n in sizes)
    assert rows.select("ncid").first()[0] == "a b"
