"""Session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings the operators count on. All are runtime SQL settings, so they can be applied to a
# session that somebody else has built. Sizes follow the input, never a fixed partition count:
# adaptive execution merges small shuffle partitions and splits skewed ones.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended runtime settings to an existing session."""
    for name, value in RECOMMENDED.items():
        spark.conf.set(name, value)
    return spark

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is begun inside are deleted as soon as it ends.

    Otherwise they stay until the driver happens to collect its garbage, so that the disk holds those of several steps."""
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path for intermediate tables, below the folder in `spark.checkpoint.dir`.

    The folder must be shared by all executors. Without the setting, a folder of the warehouse is used if the
    warehouse is configured or everything runs on one machine; a cluster without either raises, because the default warehouse
    lies on the driver's own disk.
    """
    given = spark.sparkContext.getConf()
    root = spark.conf.get("spark.checkpoint.dir", None) or given.get("spark.checkpoint.dir")
    if not root:
        if not given.contains("spark.sql.warehouse.dir") and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
