"""Session helpers. The cluster's own settings always win; nothing here overrides them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "wheelpace", shuffle_partitions: int = 8,
                  folder: str | None = None) -> SparkSession:
    """A session for tests and local runs. On a cluster use the session the cluster gives you.

    ``folder`` becomes ``spark.checkpoint.dir``; leave it out where the installation already sets one.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    if folder:
        builder = builder.config("spark.checkpoint.dir", folder)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``; an error where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that every executor can reach")
    return folder


#: Paths handed out per application, for ``scratch`` to delete.
_HANDED_OUT: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _HANDED_OUT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and, unlike a cache, survives the loss of executors. Later readers still get
    column pruning and filter push-down from the parquet scan.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a path that ``fresh_path`` handed out; nothing else can be deleted with it."""
    handed_out = _HANDED_OUT.get(spark.sparkContext.applicationId, [])
    if path not in handed_out:
        raise ValueError(f"not a path of this session: {path}")
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
    handed_out.remove(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Delete every path handed out inside the block when it ends, except those added to the given list."""
    handed_out = _HANDED_OUT.setdefault(spark.sparkContext.applicationId, [])
    before, kept = set(handed_out), []
    try:
        yield kept
    finally:
        for path in [p for p in handed_out if p not in before and p not in kept]:
            discard(spark, path)


_WRITTEN: dict[tuple[str, str], object] = {}


def once_per_session(spark: SparkSession, label: str, build):
    """The result of ``build()``, made on the first call of this application and then reused."""
    key = (spark.sparkContext.applicationId, label)
    if key not in _WRITTEN:
        _WRITTEN[key] = build()
    return _WRITTEN[key]
