"""Parquet trip source with schema check, column choice and load reconciliation."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wheelpace.config import DEFAULT, TripConfig
from wheelpace.sources import schemas, versions

log = logging.getLogger(__name__)


def _contract_name(cfg: TripConfig):
    """Columns of the contract under the first name it lists, whatever their case; others as they are stored."""
    names: dict[str, str] = {}
    for c in cfg.raw:
        names.setdefault(c.lower(), c)
    return lambda stored: names.get(stored.lower(), stored)


def _footers(spark: SparkSession, path: str, cfg: TripConfig, all_files: bool = True) -> tuple[list[schemas.Part], StructType]:
    """The parts of the table and its columns, from the footers of all files; error when a required column is absent."""
    found = schemas.parts(spark, path) if all_files else [schemas.Part(spark.read.parquet(path).schema)]
    mixed = len(found) > 1
    table = schemas.unified(found, _contract_name(cfg)) if mixed else found[0].schema
    missing = [c for c in cfg.required if c not in table.names]
    if missing:
        raise ValueError(f"required columns are missing: {missing}; the table has {table.names}")
    return found, table


def read_schema(spark: SparkSession, path: str, cfg: TripConfig = DEFAULT) -> list[str]:
    """Column names of the table, from the file footers only; error when a required column is absent."""
    return _footers(spark, path, cfg)[1].names


def columns_to_read(names: list[str], cfg: TripConfig = DEFAULT) -> list[str]:
    """Required columns, then the optional ones the table has."""
    return [*cfg.required, *(c for c in cfg.optional if c in names)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Give NaN and null one meaning: Spark treats NaN as a number, above all others."""
    floats = [f.name for f in df.schema if f.dataType.simpleString() in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)).cast(df.schema[c].dataType) for c in floats})


def scan_trips(spark: SparkSession, path: str, cfg: TripConfig = DEFAULT, merge_schema: bool = True,
               file: str | None = None) -> DataFrame:
    """The chosen columns of a parquet file or folder as they are stored.

    With ``merge_schema`` all footers are read, since the files of a folder may differ in their optional columns, in the case of
    names and in types: a column that one file lacks is null there, and one that has several types
    gets the type that holds them all. ``file`` names a column for the file that a row is stored in.
    """
    found, table = _footers(spark, path, cfg, merge_schema)
    chosen = columns_to_read(table.names, cfg)
    if len(found) == 1:
        stored = [F.col("_metadata.file_path").alias(file)] if file else []
        return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path).select(*chosen, *stored)
    return schemas.scan(spark, path, found, StructType([table[c] for c in chosen]), file)


def read_trips(spark: SparkSession, path: str, cfg: TripConfig = DEFAULT, merge_schema: bool = True) -> DataFrame:
    """The chosen columns, NaN turned into null."""
    return nan_to_null(scan_trips(spark, path, cfg, merge_schema))


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned table as input of a later stage; Spark raises PATH_NOT_FOUND when it is absent."""
    return spark.read.parquet(versions.current_path(spark, path))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n_rows, n_null) for every column, from one aggregation."""
    counts = [f"count(*) - count(`{c}`) as null_{i}" for i, c in enumerate(df.columns)]
    cells = [F.struct(F.lit(c).alias("column"), F.col("n_rows"), F.col(f"null_{i}").alias("n_null"))
             for i, c in enumerate(df.columns)]
    return df.agg(*map(F.expr, ["count(*) as n_rows", *counts])).select(F.inline(F.array(*cells)))


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """Compare two loads column by column: rows and nulls on both sides, and whether they agree."""
    a = null_counts(left).select("column", F.col("n_rows").alias("rows_left"), F.col("n_null").alias("nulls_left"))
    b = null_counts(right).select("column", F.col("n_rows").alias("rows_right"), F.col("n_null").alias("nulls_right"))
    return a.join(b, "column", "full_outer").withColumns({
        "shape_match": F.col("rows_left").eqNullSafe(F.col("rows_right")),
        "nulls_match": F.col("nulls_left").eqNullSafe(F.col("nulls_right")),
    })


def require_same_load(left: DataFrame, right: DataFrame) -> dict[str, object]:
    """Error when two loads differ in rows or columns; a different null profile only warns."""
    rows = reconcile(left, right).collect()  # one row per column
    odd = [r["column"] for r in rows if not r["shape_match"]]
    if odd:
        raise ValueError(f"the two loads differ in shape, see columns {odd}")
    nulls = {r["column"]: (r["nulls_left"], r["nulls_right"]) for r in rows if not r["nulls_match"]}
    if nulls:
        log.warning("null counts differ between the loads: %s", nulls)
    return {"rows": rows[0]["rows_left"], "columns": len(rows), "shape_match": True, "missing_match": not nulls}
