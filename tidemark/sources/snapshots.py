"""Snapshot files: tab-separated text with a header, every column a string."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import quoted, to_date_strict
from tidemark.schemas import SNAPSHOT_DATE
from tidemark.sources.files import first_line, part_files
from tidemark.sources.quoted import read_records

# FIXED VALUES: how snapshot files are written and named.
FILE_ENCODING = "ISO-8859-1"
DELIMITER = "\t"
STAMP_LENGTH = 8
FILE_SUFFIXES = (".txt", ".txt.gz", ".csv", ".csv.gz", ".tsv", ".tsv.gz")
#: Longer than any file's age: the stream reads old files too.
_NO_AGE_LIMIT = "36500d"
#: Files whose first lines the driver reads at the same time; more than so many are read by a job, in tasks of so many.
_OPEN_FILES, _MANY_FILES, _FILES_PER_TASK = 32, 200, 100
_FIRST_BYTES = 1 << 16

#: Columns that tell what was wrong with a row.
LONG_ROW, SHORT_ROW, BROKEN_QUOTES = "_long_row", "_short_row", "_broken_quotes"
_BAD = "_bad_record"
_QUOTED_FIELD = r'(^|\t)"(?:[^"]|"")*"'


def list_snapshots(spark: SparkSession, folder: str, stem: str | None = None) -> DataFrame:
    """Files of a feed in a folder, those with exactly this `stem` (all if None), oldest first.

    A feed's name ends in one of FILE_SUFFIXES, in capitals or not; `readable` is false for others, so that callers
    can report them.

    `stamp` is the date prefix of the name (`YYYYMMDD_<stem>...`), `snapshot_date` its DATE (NULL
    if the name has none) and `timestamp` the modification time as HTTP date text, which is what
    the ledger compares. File contents are not read.
    """
    files = describe_files(spark.read.format("binaryFile").load(folder).select("path", "modificationTime", "length"))
    mine = files.where(F.lit(True) if stem is None else F.col("stem") == stem)
    return mine.select(
        "path", "file_name", "stem", "stamp", "snapshot_date", http_date(F.col("modificationTime")).alias("timestamp"), "length", "readable"
    ).orderBy("snapshot_date", "file_name")


def describe_files(files: DataFrame) -> DataFrame:
    """Files (path, ...) with what their names say: file_name, stem, stamp, snapshot_date and readable."""
    named = files.withColumn("file_name", F.substring_index("path", "/", -1))
    suffix = F.lit(False)
    for ending in FILE_SUFFIXES:
        suffix = suffix | F.lower("file_name").endswith(ending)
    stamp = F.regexp_extract("file_name", rf"^(\d{{{STAMP_LENGTH}}})", 1)
    return named.select(
        *named.columns, feed_stem(F.col("file_name")).alias("stem"), F.nullif(stamp, F.lit("")).alias("stamp"),
        F.try_to_date(stamp, "yyyyMMdd").alias("snapshot_date"), suffix.alias("readable"),
    )


def feed_stem(file_name: Column) -> Column:
    """`20260420_feed.txt` and `feed.txt` both give `feed`: the name up to its first dot, without a date prefix."""
    return F.regexp_replace(F.substring_index(file_name, ".", 1), rf"^\d{{{STAMP_LENGTH}}}_", "")


def http_date(time: Column) -> Column:
    """A timestamp as HTTP date text in GMT."""
    zone = F.current_timezone()
    utc = F.convert_timezone(zone, F.lit("UTC"), time.cast("timestamp_ntz"))
    return F.concat(F.date_format(utc, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line of a file, or of the first file of a folder."""
    files = part_files(spark, path)
    line = first_line(spark, files[0] if files else path, FILE_ENCODING)
    if line is None:
        raise ValueError(f"no header line in {path}")
    return _columns_in(line)


def _columns_in(line: str) -> list[str]:
    return [field.strip().strip('"') for field in line.split(DELIMITER)]


def header_catalogue(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, columns, layout) of each file, first lines read by tasks; files of one layout have the same digest.

    For stores that pyarrow opens (local, HDFS, S3, GCS); a file without a line has no columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, columns = batch.column(0).to_pylist(), []
            for name in names:
                store, path = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", name) if ":" in name.partition("/")[0] else f"file://{name}")
                with store.open_input_stream(path) as source:  # unpacks by the name's ending
                    line = b""
                    while b"\n" not in line and (more := source.read(_FIRST_BYTES)):
                        line += more
                line = line.partition(b"\n")[0].rstrip(b"\r").decode(FILE_ENCODING)
                columns.append(_columns_in(line) if line else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns, pa.list_(pa.string()))], ["path", "columns"])

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths) // _FILES_PER_TASK + 1)
    found = files.mapInArrow(run, "path string, columns array<string>")
    return found.withColumn("layout", F.md5(F.array_join("columns", DELIMITER)))


def headers_of(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """Column names of each file: by one job where there are many, else by the driver, several at a time."""
    if len(paths) > _MANY_FILES and all(re.match(r"(/|file:|hdfs:|s3:|gs:)", p) for p in paths):
        found = {r["path"]: r["columns"] for r in header_catalogue(spark, paths).collect()}  # one row a file
        empty = [p for p in paths if not found[p]]
        if empty:
            raise ValueError(f"no header line in {empty[0]}")
        return {p: tuple(found[p]) for p in paths}
    with ThreadPoolExecutor(_OPEN_FILES) as pool:
        return dict(zip(paths, pool.map(lambda path: tuple(header_of(spark, path)), paths), strict=True))


def _scan_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _BAD]])


def _scan_options() -> dict:
    return {
        "sep": DELIMITER, "header": True, "quote": '"', "escape": '"', "encoding": FILE_ENCODING,
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "multiLine": False,
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
        "columnPruning": False,  # a parser that skips columns does not see that a row is too long
    }


def _as_text(raw: DataFrame, columns: list[str], long_rows: str, added: list[Column], quality: bool = False) -> DataFrame:
    """Fill up missing fields with '' and deal with rows that have too many."""
    # A malformed row is kept as text; separators inside quoted fields do not count.
    bare = F.regexp_replace(F.col(_BAD), _QUOTED_FIELD, "$1")
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(DELIMITER), F.lit("")))
    is_long = F.coalesce(separators >= len(columns), F.lit(False))
    texts = [F.expr(f"coalesce({quoted(c)}, '') AS {quoted(c)}") for c in columns]
    if long_rows == "raise":
        # a filter stays when the columns are not asked for
        failure = F.raise_error(F.concat(F.lit("row with too many fields: "), F.substring(_BAD, 1, 200))).cast("boolean")
        # (and names a column of the file, as a scan of the bad-row column alone is not allowed)
        raw = raw.where(F.when(is_long, failure).otherwise(F.coalesce(F.length(F.col(f"`{columns[0]}`")), F.lit(0)) >= 0))
    elif not quality:
        added = [is_long.alias(LONG_ROW), *added]
    if quality:
        quotes = F.length(F.col(_BAD)) - F.length(F.replace(F.col(_BAD), F.lit('"'), F.lit("")))
        broken = F.coalesce(quotes % 2 == 1, F.lit(False))
        added = [is_long.alias(LONG_ROW), (F.col(_BAD).isNotNull() & ~is_long).alias(SHORT_ROW), broken.alias(BROKEN_QUOTES), *added]
    return raw.select(*texts, *added)


def file_stamp() -> Column:
    """Date prefix of the name of the file a row comes from."""
    return F.substring(F.col("_metadata.file_name"), 1, STAMP_LENGTH)


def read_snapshot(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | None = None,
    multiline: bool = False,
    long_rows: str = "raise",
    stamp_column: str | None = None,
    quality: bool = False,
) -> DataFrame:
    """Scan snapshot files that share one header. Every column is text and '' is never NULL.

    Text such as `NA` stays as it is and a short row is filled up with ''. A row with more
    fields than the header fails the job (`long_rows='raise'`), or keeps its leading fields and
    is marked in a boolean column `_long_row` (`'flag'`). `columns` are the header's names, read
    from the files if not given. `multiline` accepts line breaks inside quotes (`sources.quoted`); it reads the
    text twice, so it is off by default. `stamp_column` adds a column with the date
    prefix of the file a row comes from. `quality` adds `_long_row`, `_short_row` and `_broken_quotes` (a row
    of the wrong length with an odd number of quotes).
    """
    if long_rows not in ("raise", "flag"):
        raise ValueError(f"long_rows must be 'raise' or 'flag', not {long_rows!r}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    if columns is None:
        headers = set(headers_of(spark, paths).values())
        if len(headers) > 1:
            raise ValueError("the files have different headers; read them with read_dated_snapshots")
        columns = list(headers.pop())
    if multiline:
        records = read_records(spark, paths, FILE_ENCODING)
        options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _scan_options().items() if k not in ("header", "encoding", "columnPruning")}
        ddl = ", ".join(f"{quoted(c)} string" for c in [*columns, _BAD])
        raw = records.select("path", F.from_csv("record", ddl, options).alias("r")).select("path", "r.*")
        stamp = F.substring(F.substring_index("path", "/", -1), 1, STAMP_LENGTH)
    else:
        raw, stamp = spark.read.schema(_scan_schema(columns)).options(**_scan_options()).csv(paths), file_stamp()
    return _as_text(raw, columns, long_rows, [stamp.alias(stamp_column)] if stamp_column else [], quality)


def stream_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files as they arrive in a folder: path and modificationTime. Their contents are not read."""
    return (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFileAge", _NO_AGE_LIMIT).load(folder).select("path", "modificationTime")
    )


def read_dated_snapshots(
    spark: SparkSession,
    paths: list[str] | dict[str, str],
    prepare: Callable[[DataFrame], DataFrame],
    **options,
) -> DataFrame:
    """Dated files as one DataFrame, rows stamped with their file's date.

    Files are grouped by header and each group is one scan, so files of different layouts can
    be mixed. `prepare` turns a scan (all text, plus the date column) into the common schema. Where the date is not the
    prefix of the name, `paths` maps each file to its stamp (`yyyyMMdd`).
    """
    stamps = paths if isinstance(paths, dict) else {}
    groups: dict[tuple[tuple[str, ...], str | None], list[str]] = defaultdict(list)
    for path, header in headers_of(spark, list(paths)).items():
        own = stamps.get(path)
        groups[header, None if own is None or path.rpartition("/")[2].startswith(own) else own].append(path)
    parts = []
    for (header, stamp), group in groups.items():
        scan = read_snapshot(spark, group, list(header), stamp_column="_stamp", **options)
        dated = scan.withColumn(SNAPSHOT_DATE, to_date_strict(F.col("_stamp") if stamp is None else F.lit(stamp))).drop("_stamp")
        parts.append(prepare(dated))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
