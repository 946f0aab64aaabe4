"""Registration snapshots that arrive after newer ones, or again, spliced into the stored history.

A stored history holds the rows that differed from the row observed before. Putting in a date changes, per key, the row of
that date and at most one more: the next one observed after it. If its value now equals the row before, it goes; if it had been
skipped because it equalled the row before the late date, it is stored after all, with the content of that row. Rows after it
are compared with it, as before, so nothing else moves.

What was observed and not stored is known from the `skipped:<date>` side tables. Only keys whose value changes with the late date
are looked up in later dates, and only the partitions that hold such rows are written again, in one commit.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.changes import NullEquality
from tidemark.operators.joins import split_join
from tidemark.operators.keys import latest_per_key
from tidemark.operators.series import HAS_NULL, MARK_FIELDS, MARKS, marks_of, same_row
from tidemark.plans.feeds import LATEST, NOTED, SKIPPED, LateSnapshot, check_decided, narrow_history, work_table
from tidemark.schemas import KEY, SNAPSHOT_DATE
from tidemark.sinks.tables import Draft
from tidemark.sources.manifest import SIDES, Manifest
from tidemark.sources.tables import read_table


def _skipped(spark: SparkSession, table: str, manifest: Manifest, dates: list[str]) -> DataFrame:
    """(key, date) of rows that were observed on these dates and not stored."""
    schema = f"{KEY} string, {SNAPSHOT_DATE} date"
    paths = [f"{table}/{p}" for d in dates for p in manifest.sides.get(f"{SKIPPED}:{d}", [])]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", f"{table}/{SIDES}/{SKIPPED}").schema(schema).parquet(*paths).select(KEY, SNAPSHOT_DATE)


def splice_registrations(spark: SparkSession, staged: DataFrame, day: str, table: str, null_equality: NullEquality = "sql") -> int:
    """Put one marked snapshot of `day` in its place; returns the rows stored for it. The table is then as if rebuilt."""
    at = F.lit(day).cast("date")
    with Draft(spark, table) as draft:
        if NOTED not in draft.base.sides:
            raise LateSnapshot(f"snapshot {day} is late and the table does not note which rows its snapshots skipped; rebuild it")
        history = narrow_history(spark, table, draft.base)
        later = [d for d in draft.base.values if d > day]
        before = latest_per_key(history.where(F.col(SNAPSHOT_DATE) < at), [KEY], SNAPSHOT_DATE)
        present = history.where(F.col(SNAPSHOT_DATE) == at)
        side = lambda df, name: df.select(F.col(KEY).alias(f"_{name}_key"), F.struct(F.col(SNAPSHOT_DATE).alias("date"), marks_of().alias("marks")).alias(name))
        new = staged.select(KEY, SNAPSHOT_DATE, *MARKS)
        joined = (
            side(new, "new").join(side(before, "before"), F.col("_new_key") == F.col("_before_key"), "full")
            .withColumn(KEY, F.coalesce("_new_key", "_before_key"))
            .join(side(present, "present"), F.col(KEY) == F.col("_present_key"), "full")
            .withColumn(KEY, F.coalesce(KEY, "_present_key"))
        )
        same = same_row("before.marks", "new.marks")
        if null_equality == "sql":
            same = same & ~F.col(f"new.marks.{HAS_NULL}")
        decisions = joined.select(
            KEY,
            F.col("new").isNotNull().alias("own"),
            (F.col("new").isNotNull() & (F.col("before").isNull() | ~same)).alias("kept"),
            F.coalesce(F.col("new.marks"), F.col("before.marks")).alias("value"),  # in force after the date
            F.coalesce(F.col("present.marks"), F.col("before.marks")).alias("old_value"),
            F.coalesce(F.col("present.date"), F.col("before.date")).alias("old_date"),
        )
        with work_table(decisions, "splice") as decided:
            rows = decided.where("own").select(KEY, F.lit(dt.date.fromisoformat(day)).alias(SNAPSHOT_DATE), "kept", F.lit(False).alias("repeated"))
            kept = check_decided(_with_repeats(rows, new))
            changed = decided.where(~F.coalesce(F.col("value").eqNullSafe(F.col("old_value")), F.lit(False)))
            after = history.where(F.col(SNAPSHOT_DATE) > at).select(KEY, SNAPSHOT_DATE, marks_of().alias("marks")).unionByName(
                _skipped(spark, table, draft.base, later), allowMissingColumns=True
            )
            following = split_join(after, changed.select(KEY), [KEY], "left_semi").groupBy(KEY).agg(
                F.min_by(F.struct(SNAPSHOT_DATE, "marks"), SNAPSHOT_DATE).alias("next")
            )
            moved = following.join(changed.select(KEY, "value", "old_value", "old_date"), KEY)
            equal = same_row("value", "next.marks")
            if null_equality == "sql":
                equal = equal & ~F.col(f"next.marks.{HAS_NULL}")
            actions = moved.select(
                KEY, F.col(f"next.{SNAPSHOT_DATE}").alias(SNAPSHOT_DATE), "old_date",
                F.col("next.marks").isNull().alias("skipped"), F.coalesce(equal, F.lit(False)).alias("equal"),
                same_row("value", "old_value").alias("alike"),
            )
            with work_table(actions.where("(NOT skipped AND equal) OR (skipped AND NOT alike)"), "actions") as moves:
                touched = sorted(r[0].isoformat() for r in moves.select(SNAPSHOT_DATE).distinct().collect())
                wide = [*schemas.REGISTRATION_TABLE.names, *MARKS]
                own = split_join(staged, decided.where("kept").select(KEY), [KEY], "left_semi").select(*wide)
                stored = read_table(spark, table, schemas.REGISTRATION_TABLE, MARK_FIELDS, manifest=draft.base)
                stay = read_table(spark, table, schemas.REGISTRATION_TABLE, MARK_FIELDS, manifest=draft.base, values=touched)
                stay = split_join(stay, moves.where("NOT skipped").select(KEY, SNAPSHOT_DATE), [KEY, SNAPSHOT_DATE], "left_anti")
                brought = moves.where("skipped").select(KEY, F.col("old_date").alias(SNAPSHOT_DATE), F.col(SNAPSHOT_DATE).alias("_to"))
                copies = split_join(stored, brought, [KEY, SNAPSHOT_DATE]).withColumn(SNAPSHOT_DATE, F.col("_to")).select(*wide)
                counts = draft.write(own.unionByName(stay.select(*wide)).unionByName(copies))
                unseen = decided.where("own AND NOT kept").select(KEY, F.lit(dt.date.fromisoformat(day)).alias(SNAPSHOT_DATE))
                again = _skipped(spark, table, draft.base, touched)
                again = split_join(again, moves.where("skipped").select(KEY, SNAPSHOT_DATE), [KEY, SNAPSHOT_DATE], "left_anti")
                again = again.unionByName(moves.where("NOT skipped").select(KEY, SNAPSHOT_DATE))
                draft.write_dated_side(SKIPPED, unseen.unionByName(again))
            replaced = {day, *touched}
            draft.commit(counts, replaced, sides=lambda n: n == NOTED or (n.startswith(f"{SKIPPED}:") and n[len(SKIPPED) + 1 :] not in replaced) or (n.startswith(f"{LATEST}:") and n[len(LATEST) + 1 :] < day))
    return kept.get(day, 0)


def _with_repeats(rows: DataFrame, new: DataFrame) -> DataFrame:
    """Mark keys that a snapshot has twice, by an aggregate over its keys."""
    twice = new.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col(KEY).alias("_twice"))
    return rows.join(twice, F.col(KEY) == F.col("_twice"), "left").withColumn("repeated", F.col("_twice").isNotNull())
