"""Folder operations on any file system Spark can reach (HDFS, object store, local)."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Does the file or folder exist?"""
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def partition_values(spark: SparkSession, table: str, column: str) -> list[str]:
    """Values of the partition column, from folder names: no data is read."""
    fs, hadoop_path = _fs(spark, table)
    if not fs.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path) if status.isDirectory()]
    found = (re.fullmatch(re.escape(column) + "=(.*)", name) for name in names)
    return sorted(match.group(1) for match in found if match)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move `source` to `target`. Both lie on one file system.

    An existing `target` is first moved aside, and back if the new one cannot take its place; what is
    moved aside by a run that then died is put back by `recover_folder`, or here by the next run.
    """
    recover_folder(spark, target)
    fs, from_path = _fs(spark, source)
    _, to_path = _fs(spark, target)
    _, old_path = _fs(spark, _aside(target))
    fs.mkdirs(to_path.getParent())
    if fs.exists(to_path) and not fs.rename(to_path, old_path):
        raise OSError(f"could not move {target} aside")
    try:
        if not fs.rename(from_path, to_path):
            raise OSError(f"could not move {source} to {target}")
    except BaseException:
        recover_folder(spark, target)
        raise
    fs.delete(old_path, True)


def _aside(target: str) -> str:
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/_old-{name}"  # readers skip names with a leading underscore


def recover_folder(spark: SparkSession, target: str) -> bool:
    """Finish a replacement that was interrupted: put the old folder back if no new one is there."""
    fs, to_path = _fs(spark, target)
    _, old_path = _fs(spark, _aside(target))
    if not fs.exists(old_path):
        return False
    if fs.exists(to_path):
        fs.delete(old_path, True)
        return False
    if not fs.rename(old_path, to_path):
        raise OSError(f"could not put {target} back")
    return True


def first_line(spark: SparkSession, path: str, encoding: str) -> str | None:
    """First line of a text file, unpacked if its name says it is compressed. Starts no job."""
    jvm = spark.sparkContext._jvm
    fs, hadoop_path = _fs(spark, path)
    stream = fs.open(hadoop_path)
    try:
        codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
        codec = codecs.getCodec(hadoop_path)
        data = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, encoding)).readLine()
    finally:
        stream.close()


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder if it does not exist."""
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by this library."""
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """Data files below a folder, without marker files."""
    fs, hadoop_path = _fs(spark, folder)
    found, files = [], fs.listFiles(hadoop_path, True)
    while files.hasNext():
        path = files.next().getPath()
        if path.getName().startswith("part-"):
            found.append(path.toString())
    return sorted(found)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move one file within its file system, creating the folder it goes to."""
    fs, from_path = _fs(spark, source)
    _, to_path = _fs(spark, target)
    fs.mkdirs(to_path.getParent())
    if not fs.rename(from_path, to_path):
        raise OSError(f"could not move {source} to {target}")


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files directly in a folder; none if there is no folder."""
    fs, hadoop_path = _fs(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path) if status.isFile())


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly in a folder; none if there is no folder."""
    fs, hadoop_path = _fs(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path) if status.isDirectory())


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file; None if there is none."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small text file; False if a file of that name exists already."""
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    try:
        stream = fs.create(hadoop_path, False)
    except Exception as error:
        if "AlreadyExists" in str(error):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True
