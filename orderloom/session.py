"""Session settings the jobs expect, and the scratch folder they may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The JVM does not compile methods of over 8000 bytecodes. Queries with many
# expressions per column generate such methods unless told to split them.
WIDE_QUERY = {"spark.sql.codegen.hugeMethodLimit": "8000"}

SETTINGS = {
    **WIDE_QUERY,
    # AQE picks the number of shuffle partitions, the join side to broadcast
    # (by measured size) and splits skewed sort-merge partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("orderloom")
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a while; the old ones come back afterwards."""
    old = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, label: str, root: str | None = None) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Where that is
    unset, it lies under ``root``; without one, in a local temporary folder, which
    only a session on one machine may use.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or root
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"{label}-")
