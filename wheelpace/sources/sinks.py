"""Parquet, CSV and JSON sinks, each verified by what the written files hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def save_cleaned(df: DataFrame, path: str) -> dict[str, object]:
    """Write snappy parquet, read it back and compare row count, columns and types.

    The rows are counted while they are written, so the input is not computed a second time; the
    count of the written table comes from the parquet footers.
    """
    written = Observation("written")
    counted = df.observe(written, F.count(F.lit(1)).alias("n"))
    counted.write.mode("overwrite").option("compression", "snappy").parquet(path)
    n = written.get["n"]

    back = df.sparkSession.read.parquet(path)
    rows = back.count()
    if rows != n:
        raise ValueError(f"{n} rows were written to {path}, {rows} were read back")
    names = [(f.name, f.dataType) for f in df.schema]
    if [(f.name, f.dataType) for f in back.schema] != names:
        raise ValueError(f"the columns of {path} differ from those written")
    return {"path": path, "rows": rows, "columns": back.columns, "reload_verified": True}


def place(spark: SparkSession, path: str):
    """A path as the file system of the cluster knows it, and that file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    target, files = place(spark, path)
    files.delete(target, True)


def save_csv(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One CSV folder with a header per result table."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in tables}
    for name, table in tables.items():
        table.write.mode("overwrite").csv(paths[name], header=True)
    return paths


def save_counted(tables: dict[str, DataFrame], folder: str) -> dict[str, dict[str, object]]:
    """As :func:`save_csv`; the path and the rows of each table, counted while they are written."""
    saved = {}
    for name, table in tables.items():
        rows, path = Observation(name), f"{folder.rstrip('/')}/{name}"
        table.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("overwrite").csv(path, header=True)
        saved[name] = {"path": path, "rows": rows.get["n"]}
    return saved


def save_json(row: DataFrame, path: str) -> str:
    """A one-row result as JSON."""
    row.write.mode("overwrite").json(path)
    return path
