"""Delimited text with line breaks inside quotes, read by many tasks.

Whether a line begins a record depends on all text before it. But a line can only do three things to the state "inside quotes":
keep it, flip it, or set it, and such steps compose. So a first pass gives one step for each split of a file, the steps
of a file are run through in order, and with the state at its beginning each split finds its records by itself. Records that cross
splits, at most one for each boundary, are put together from their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A quoted field, and the rest of one that began on an earlier line. A quote in the middle of a field does not count.
_FIELD = r'(^|\t)"(?:[^"]|"")*+"'
_OPENS = r'(^|\t)"'
_CLOSES = r'^(?:[^"]|"")*+"'


def _opens(line: Column) -> Column:
    return F.regexp_replace(line, _FIELD, "$1x").rlike(_OPENS)


def _lines(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """Lines in the order of their splits, with the state after each if it began outside or inside quotes."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    text = F.decode(F.col("value").cast("binary"), encoding)
    lines = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), text.alias("line"))
    inside = F.when(F.col("line").rlike(_CLOSES), _opens(F.regexp_replace("line", _CLOSES, "x"))).otherwise(True)
    return lines.select("path", "start", "line", _opens(F.col("line")).alias("outside"), inside.alias("inside"))


def states(outside: np.ndarray, inside: np.ndarray, first: bool) -> np.ndarray:
    """State before each line and after the last, from the state before the first."""
    sets = np.concatenate([[True], outside == inside])
    value = np.concatenate([[first], outside])
    flips = np.concatenate([[False], outside & ~inside])
    count = np.cumsum(flips)
    last = np.maximum.accumulate(np.where(sets, np.arange(len(sets)), 0))
    return value[last] ^ ((count - count[last]) % 2 == 1)


def _splits(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], slice]]:
    """Consecutive lines of a batch that are of one split."""
    path, start = batch.column("path"), batch.column("start").to_numpy()
    names = path.dictionary_encode().indices.to_numpy()
    cut = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]) | (start[1:] != start[:-1]), [True]])) if len(batch) else np.zeros(1, int)
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        yield (path[a].as_py(), int(start[a])), slice(a, b)


def _flags(batch: pa.RecordBatch, name: str, part: slice) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)[part].astype(bool)


def _steps(lines: DataFrame) -> DataFrame:
    """(path, start, outside, inside): what each split does to the state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[bool]] = {}
        for batch in batches:
            for split, part in _splits(batch):
                step = found.setdefault(split, [False, True])
                outside, inside = _flags(batch, "outside", part), _flags(batch, "inside", part)
                found[split] = [bool(states(outside, inside, s)[-1]) for s in step]
        yield pa.RecordBatch.from_pydict({
            "path": [p for p, _ in found], "start": [s for _, s in found], "outside": [v[0] for v in found.values()], "inside": [v[1] for v in found.values()],
        }, pa.schema([("path", pa.string()), ("start", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_())]))

    return lines.drop("line").mapInArrow(run, "path string, start long, outside boolean, inside boolean")


def _beginnings(steps: DataFrame) -> DataFrame:
    """(path, start, state) at the beginning of each split."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("start")
        found = states(rows["outside"].to_numpy(bool), rows["inside"].to_numpy(bool), False)[:-1]
        return pd.DataFrame({"_path": rows["path"], "_start": rows["start"], "state": found})

    return steps.groupBy("path").applyInPandas(run, "_path string, _start long, state boolean")


def read_records(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """(path, record) of all records but the headers, in no order; line breaks in quotes are part of a record."""
    lines = _lines(spark, paths, encoding)
    begins = _beginnings(_steps(lines))
    # one short row a split; a join by shuffling would lose the order of the lines
    known = lines.join(F.broadcast(begins), (F.col("path") == F.col("_path")) & (F.col("start") == F.col("_start"))).drop("_path", "_start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[str, int] | None = None
        state, open_record, pieces = False, [], 0

        def piece(ended: bool) -> dict:
            return {"path": now[0], "start": now[1], "n": pieces, "ended": ended, "record": "\n".join(open_record)}

        for batch in batches:
            out: list[dict] = []
            for split, part in _splits(batch):
                if split != now:
                    if now is not None and open_record:
                        out.append(piece(False))
                    now, open_record, pieces = split, [], 0
                    state = batch.column("state")[part.start].as_py()
                before = states(_flags(batch, "outside", part), _flags(batch, "inside", part), state)
                text = batch.column("line").slice(part.start, part.stop - part.start).to_pylist()
                for k, line in enumerate(text):
                    open_record.append(line)
                    if not before[k + 1]:
                        out.append(piece(True))
                        open_record, pieces = [], pieces + 1
                state = bool(before[-1])
            yield pa.RecordBatch.from_pylist(out, schema)
        if now is not None and open_record:
            yield pa.RecordBatch.from_pylist([piece(False)], schema)

    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("n", pa.int64()), ("ended", pa.bool_()), ("record", pa.string())])
    found = known.mapInArrow(run, "path string, start long, n long, ended boolean, record string")
    found = found.join(F.broadcast(begins), (F.col("path") == F.col("_path")) & (F.col("start") == F.col("_start")))
    # a piece without an end goes on in the next split, whose first piece began before it
    loose = ~F.col("ended") | (F.col("state") & (F.col("n") == 0))
    whole = found.where(~loose & ~((F.col("start") == 0) & (F.col("n") == 0))).select("path", "record")

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        out, held, first = [], [], (0, 0)
        for row in rows.sort_values(["start", "n"]).itertuples(index=False):
            first = first if held else (row.start, row.n)
            held.append(row.record)
            if row.ended:
                if first != (0, 0):
                    out.append("\n".join(held))
                held = []
        if held and first != (0, 0):  # a quote that is never closed
            out.append("\n".join(held))
        return pd.DataFrame({"path": [rows["path"].iloc[0]] * len(out), "record": out})

    crossing = found.where(loose).select("path", "start", "n", "ended", "record").groupBy("path").applyInPandas(join, "path string, record string")
    return whole.unionByName(crossing).withColumn("record", F.regexp_replace("record", r"\r$", "")).where(F.col("record") != "")
