"""Tables whose files differ in the types of their columns: files of one schema are scanned together and cast.

Spark reads all footers of a table in one distributed job and merges them, as long as no column has two
types. Where one has, the files are halved, in the order of their names, until every part merges. Parts of the
same schema are one scan, so a table written in a few eras is a few scans however many files it has.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructField, StructType,
    TimestampNTZType, TimestampType,
)

#: Types from narrow to wide; every value of one is a value of the next.
_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_REAL = (FloatType, DoubleType)
_TIMES = (DateType, TimestampType, TimestampNTZType)


@dataclass(frozen=True)
class Part:
    """Files that Spark can read with one schema; ``files`` is None for the whole table."""

    schema: StructType
    files: tuple[str, ...] | None = None


def _merged(spark: SparkSession, base: str, files: list[str] | None) -> StructType | None:
    """The schema of all columns of the files, None where a column has two types."""
    reader = spark.read.option("mergeSchema", "true")
    try:
        if files is None:
            return reader.parquet(base).schema
        return reader.option("basePath", base).parquet(*files).schema
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
        return None


def parts(spark: SparkSession, path: str) -> list[Part]:
    """The table at ``path`` as parts of one schema each, in the order of their first files."""
    whole = _merged(spark, path, None)
    if whole is not None:
        return [Part(whole)]
    files = sorted(unquote(f) for f in spark.read.parquet(path).inputFiles())
    found: dict[str, tuple[StructType, list[str]]] = {}
    waiting = [files]
    while waiting:
        some = waiting.pop()
        schema = _merged(spark, path, some)
        if schema is None:
            waiting += [some[len(some) // 2:], some[:len(some) // 2]]
            continue
        found.setdefault(schema.simpleString(), (schema, []))[1].extend(some)
    return [Part(schema, tuple(members)) for schema, members in found.values()]


def wider(name: str, a: DataType, b: DataType) -> DataType:
    """The type that holds the values of both; error where there is none."""
    if a == b:
        return a
    kinds = (type(a), type(b))
    if all(k in _WHOLE for k in kinds):
        return max((a, b), key=lambda t: _WHOLE.index(type(t)))
    if all(k in (*_WHOLE, *_REAL, DecimalType) for k in kinds):
        return DoubleType()
    if all(k in _TIMES for k in kinds):
        return TimestampNTZType()  # wall-clock times, as everywhere here
    raise ValueError(f"column {name} is {a.simpleString()} in some files and {b.simpleString()} in others")


def unified(found: list[Part], canonical: Callable[[str], str] = lambda name: name) -> StructType:
    """All columns of all parts with types that hold every part's values, in the order in which they first appear.

    Names that differ in case only are one column, under the name that ``canonical`` gives it.
    """
    columns: dict[str, StructField] = {}
    for part in found:
        for f in part.schema:
            key = f.name.lower()
            if key in columns:
                columns[key] = StructField(columns[key].name, wider(f.name, columns[key].dataType, f.dataType))
            else:
                columns[key] = StructField(canonical(f.name), f.dataType)
    return StructType(list(columns.values()))


def scan(spark: SparkSession, path: str, found: list[Part], target: StructType, file: str | None = None) -> DataFrame:
    """The columns of ``target`` over all parts, each cast to its type, null where a part lacks it; in the column
    ``file``, if it is named, where a row is stored."""
    stored = [F.col("_metadata.file_path").alias(file)] if file else []
    scans = []
    for part in found:
        rows = spark.read.option("basePath", path).schema(part.schema).parquet(*part.files)
        own = {f.name.lower(): f.name for f in part.schema}
        scans.append(rows.select(*(
            (F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target), *stored))
    return reduce(DataFrame.unionAll, scans)
