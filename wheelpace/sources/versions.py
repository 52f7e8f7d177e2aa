"""Tables that are replaced as a whole: every version is checked before an entry in a log makes it the current one.

A table is a folder of version folders and a folder of numbered entries. Readers take the version that the
newest complete entry names. The entry is the last thing that is written and nothing is overwritten, so a run
that dies at any point leaves the table as it was, on any file system that can create a file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wheelpace.sources.sinks import place, remove

LOG = "published"


def fingerprint(columns: list[str]) -> list[Column]:
    """Aggregates that tell tables apart whatever the order of their rows: their number and the sum of their hashes."""
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(F.xxhash64(*(F.col(f"`{c}`") for c in columns)).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum")]


def _read(spark: SparkSession, path) -> str:
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_entry(spark: SparkSession, path: str, entry: dict) -> None:
    """A new small file of JSON; an error if it is there already."""
    target, files = place(spark, path)
    stream = files.create(target, False)
    stream.write(bytearray((json.dumps(entry, sort_keys=True) + "\n").encode()))
    stream.close()


def entries(spark: SparkSession, folder: str) -> list[dict]:
    """What the complete entries of a folder say, in the order of their names; a torn one counts as absent."""
    target, files = place(spark, folder)
    if not files.exists(target):
        return []
    found = []
    for status in sorted(files.listStatus(target), key=lambda s: s.getPath().getName()):
        name = status.getPath().getName()
        if name.startswith((".", "_")) or not name.endswith(".json"):
            continue
        text = _read(spark, status.getPath())
        try:
            found.append(json.loads(text) | {"name": name})
        except ValueError:
            continue
    return found


def current(spark: SparkSession, path: str) -> dict | None:
    """The entry of the current version (folder, rows, checksum), None for a folder that is no such table."""
    found = entries(spark, f"{path.rstrip('/')}/{LOG}")
    return found[-1] if found else None


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of the table are: its current version, or the folder itself if it is a plain one."""
    entry = current(spark, path)
    return f"{path.rstrip('/')}/{entry['folder']}" if entry else path


def publish(df: DataFrame, path: str, check: Callable[[DataFrame], None] | None = None) -> dict[str, object]:
    """Write ``df`` as a new version of the table at ``path`` and make it the current one once it is proved.

    Rows and their checksum are taken while writing and again from the files; then ``check`` may raise an error.
    A version that fails is deleted. The version before stays for readers that have begun with it.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    before = entries(spark, f"{base}/{LOG}")
    number = int(before[-1]["name"].removesuffix(".json")) + 1 if before else 1
    folder = f"version-{uuid.uuid4().hex}"
    written = Observation("written")
    df.observe(written, *fingerprint(df.columns)).write.option("compression", "snappy").parquet(f"{base}/{folder}")
    back = spark.read.parquet(f"{base}/{folder}")
    try:
        if [(f.name, f.dataType) for f in back.schema] != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"the columns of {base}/{folder} differ from those written")
        verify(back, written.get)
        if check:
            check(back)
    except ValueError:
        remove(spark, f"{base}/{folder}")
        raise
    write_entry(spark, f"{base}/{LOG}/{number:012d}.json", {"folder": folder, **written.get})
    for old in before[:-1]:
        remove(spark, f"{base}/{old['folder']}")
    return {"path": path, "folder": folder, **written.get, "columns": back.columns, "reload_verified": True}


def verify(df: DataFrame, entry: dict) -> None:
    """Error where the rows of ``df`` are not those that the entry stands for."""
    found = df.agg(*fingerprint(df.columns)).first().asDict()
    if odd := {k: (entry[k], v) for k, v in found.items() if entry[k] != v}:
        raise ValueError(f"the stored rows differ from those written: {odd}")
