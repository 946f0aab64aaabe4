"""Shared steps of the operators in this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.session import work_folder
from tidemark.sources.files import remove_folder

#: Rows of an id list that may be broadcast (16 bytes each in the join's table, so 8 MB).
BROADCAST_IDS = 500_000


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors."""
    return _stored(df, purpose)[0]


def _stored(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


class Scratch:
    """Materialized tables that are deleted at the end of the block, or before; what is read later has to be written by then."""

    def __init__(self) -> None:
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error: object) -> None:
        self.drop(*[df for df, _ in self._paths.values()])

    def materialize(self, df: DataFrame, purpose: str) -> DataFrame:
        out, path = _stored(df, purpose)
        self._paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            remove_folder(df.sparkSession, self._paths.pop(id(df))[1])


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, after which unused Arrow memory goes back to the system: a worker stays for tasks of later stages."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return tidied


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key's text, modulo the number of folds; 0 for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds, F.lit(0))


def join_ids(df: DataFrame, ids: DataFrame, on: str, how: str = "left_semi", bound: int = BROADCAST_IDS) -> DataFrame:
    """Join with a narrow table of ids: broadcast if its counted rows are within the bound, else shuffled."""
    small = ids.limit(bound + 1).count() <= bound
    return df.join(F.broadcast(ids) if small else ids, on, how)


def schema_with(df: DataFrame, *fields: tuple[str, str]) -> StructType:
    """The schema of a table and further (name, type) columns; `add` would change the table's own."""
    return StructType([*df.schema.fields, *(StructField(n, StructType.fromDDL(f"x {t}")["x"].dataType) for n, t in fields)])


def unit_hash(key: str) -> Column:
    """A number in [0, 1) that depends on the key's text only."""
    return F.pmod(F.xxhash64(F.lit(17), F.col(key).cast("string")), F.lit(1 << 40)) / float(1 << 40)


def sampled_labels(labels: DataFrame, label: str, rows: int, key: str = "doc_id") -> tuple[DataFrame, dict[int, float]]:
    """(key, label) of about `rows` rows of each class 0 and 1, chosen by a hash of the key, and the rate of each class.

    The labels are narrow, so this bounds the sample before any text is read. Other labels are left out."""
    known = labels.where(F.col(label).isin(0, 1)).select(key, F.col(label).cast("int").alias(label))
    counts = {r[label]: r["n"] for r in known.groupBy(label).agg(F.count("*").alias("n")).collect()}
    rate = {y: min(1.0, rows / n) for y, n in counts.items()}
    limit = F.when(F.col(label) == 1, rate.get(1, 0.0)).otherwise(rate.get(0, 0.0))
    return known.where(unit_hash(key) < limit), rate


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges; the component is the smallest node reachable.

    Alternates the large-star and small-star steps of Kiveris et al. (2014): each step only groups by
    a node and needs the minimum of its neighbours, so a hot node is a partial aggregate and a join that
    adaptive execution can split. Each step is a plan of its own, written to the shared folder, and the one before it is deleted: the driver
    plans a step again after each of its shuffles, which takes it much memory for both steps in one. Ends when nothing moves.
    """
    pairs, path = _stored(edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u <> v").distinct(), "edges")
    for _ in range(rounds):
        turned = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = pairs.select("u", "v").unionByName(turned).groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # u <> v in every row, and no more rows than pairs
        down, middle = _stored(turned.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        remove_folder(pairs.sparkSession, path)
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        pairs, path = _stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        remove_folder(pairs.sparkSession, middle)
        # a star forest: no node is both a centre and a leaf, and every leaf has one centre
        ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("leaf")).unionByName(pairs.select(F.col("v").alias("node"), F.lit(0).alias("leaf")))
        odd = ends.groupBy("node").agg(F.sum("leaf").alias("leaves"), F.min("leaf").alias("least")).where("leaves > 1 or leaves = 1 and least = 0").limit(1).count()
        if not odd:
            break
    else:
        raise RuntimeError("components did not settle")
    leaves = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
