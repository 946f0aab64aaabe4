"""The stored ledger: one JSON line per status change, only ever appended to.

A state is written by appending a line with a higher sequence number, so a crash can never
leave a half-written ledger behind and the history of every file stays visible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import LEDGER
from tidemark.sources.files import exists


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Current entry per file. No ledger or an unreadable one gives an empty result.

    A missing `processed` counts as true; `archived` is the last one that was given.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    lines = (
        spark.read.text(path)
        .select(F.from_json("value", "seq long, file_name string, timestamp string, processed boolean, archived boolean").alias("e"))
        .select("e.*")
        .where(F.col("file_name").isNotNull())
        .withColumn("seq", F.coalesce("seq", F.lit(0)))
    )
    return lines.groupBy("file_name").agg(
        F.max_by("timestamp", "seq").alias("timestamp"),
        F.coalesce(F.max_by("processed", "seq"), F.lit(True)).alias("processed"),
        F.max_by("archived", F.when(F.col("archived").isNotNull(), F.col("seq"))).alias("archived"),
    )


def read_ledger_document(spark: SparkSession, path: str) -> DataFrame:
    """A ledger kept as one JSON object: file name to an entry, or to a bare timestamp (old form).

    An old-form entry counts as processed. A missing or corrupt document gives an empty result.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    entries = (
        spark.read.text(path, wholetext=True)
        .select(F.explode(F.from_json("value", "map<string,string>")).alias("file_name", "entry"))
    )
    is_object = F.col("entry").startswith("{")
    entry = F.from_json("entry", "timestamp string, processed boolean, archived boolean")
    return entries.select(
        "file_name",
        F.when(is_object, entry["timestamp"]).otherwise(F.col("entry")).alias("timestamp"),
        F.when(is_object, F.coalesce(entry["processed"], F.lit(True))).otherwise(F.lit(True)).alias("processed"),
        F.when(is_object, entry["archived"]).alias("archived"),
    )


def write_ledger(spark: SparkSession, path: str, updates: DataFrame) -> None:
    """Append status changes (file_name, timestamp, processed, archived).

    A NULL `archived` leaves the stored flag as it is. Also seeds a new ledger, for instance
    from `read_ledger_document`.
    """
    last = 0
    if exists(spark, path):
        found = spark.read.text(path).agg(F.max(F.from_json("value", "seq long")["seq"])).first()[0]
        last = found or 0
    line = F.to_json(F.struct(F.lit(last + 1).alias("seq"), *LEDGER.names))
    updates.select(line.alias("value")).coalesce(1).write.mode("append").text(path)
