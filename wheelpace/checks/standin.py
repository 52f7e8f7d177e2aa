"""Trips derived from the ``events`` table: no given table holds trips.

Every row of ``events`` becomes a trip; fixed shares of them carry the defects that cleaning has to
find (null fields that are missing together, refunds, zero and impossible distances, no passengers,
swapped and endless times, another month) and some trips appear twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wheelpace.config import DEFAULT
from wheelpace.plans.runs import Prepared, prepare_file
from wheelpace.session import fresh_path, once_per_session


def trips_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    key, ts, value = F.col("event_id"), F.col("ts").cast("timestamp_ntz"), F.col("value")
    kind, blank = key % 600, key % 40 == 7
    seconds = F.lit(300) + (key * 7919) % 2400
    minutes = seconds / 60.0
    slow = ((F.day(ts) - 1) % 7 < 5) & F.hour(ts).isin(*DEFAULT.rush_hours)
    mph = 14.0 + (key * 31) % 70 / 10.0 - F.when(slow, 6.0).otherwise(0.0)

    def moment(text: str):
        return F.lit(text).cast("timestamp_ntz")

    def present(column):
        return F.when(~blank, column)

    trips = e.select(
        (key % 2 + 1).cast("int").alias("VendorID"),
        F.when(kind == 50, moment("2011-07-19 06:30:00")).otherwise(ts).alias("tpep_pickup_datetime"),
        F.when(kind == 50, moment("2011-07-19 06:52:00"))
        .when(kind == 500, ts - F.expr("interval 9 minutes"))
        .when(kind == 550, ts + F.expr("interval 13 hours"))
        .otherwise(ts + F.make_dt_interval(secs=seconds)).alias("tpep_dropoff_datetime"),
        present(F.when(kind == 400, 0.0).otherwise((key % 5 + 1).cast("double"))).alias("passenger_count"),
        F.when(kind == 25, F.lit(None)).when(kind == 200, 0.0).when(kind == 300, 1234.5)
        .otherwise(mph * seconds / 3600.0).alias("trip_distance"),
        present(F.lit(1.0)).alias("RatecodeID"),
        (F.col("user_id") % 265 + 1).cast("int").alias("PULocationID"),
        ((key * 17) % 265 + 1).cast("int").alias("DOLocationID"),
        (key % 4 + 1).alias("payment_type"),
        F.when(kind == 100, -7.25).otherwise(3.0 + minutes).alias("fare_amount"),
        (value / 10.0).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.when(kind == 575, -1.0).otherwise(4.0 + minutes + value / 10.0).alias("total_amount"),
        present(F.lit(2.5)).alias("congestion_surcharge"),
        present(F.lit(0.0)).alias("airport_fee"),
    )
    again = (F.second("tpep_pickup_datetime") < 1) & (F.col("VendorID") == 1)
    # One scan: the repeated trips are emitted twice instead of being read a second time.
    return trips.withColumn("copy", F.explode(F.when(again, F.sequence(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))))).drop("copy")


def trips_sql() -> str:
    """The same trips as DuckDB common table expressions, ending in ``trips``."""
    return """
base AS (
  SELECT event_id, ts, user_id, value, event_id % 600 AS kind, event_id % 40 = 7 AS blank,
         300 + (event_id * 7919) % 2400 AS dur_s,
         14.0::DOUBLE + ((event_id * 31) % 70) / 10.0::DOUBLE
           - CASE WHEN (day(ts) - 1) % 7 < 5 AND hour(ts) IN (7,8,9,16,17,18,19) THEN 6.0::DOUBLE ELSE 0.0::DOUBLE END AS mph
  FROM events
), once AS (
  SELECT CAST(1 + event_id % 2 AS INT) AS VendorID,
    CASE WHEN kind = 50 THEN TIMESTAMP '2011-07-19 06:30:00' ELSE CAST(ts AS TIMESTAMP) END AS tpep_pickup_datetime,
    CASE WHEN kind = 50 THEN TIMESTAMP '2011-07-19 06:52:00'
         WHEN kind = 500 THEN CAST(ts AS TIMESTAMP) - INTERVAL '9' MINUTE
         WHEN kind = 550 THEN CAST(ts AS TIMESTAMP) + INTERVAL '13' HOUR
         ELSE CAST(ts AS TIMESTAMP) + dur_s * INTERVAL '1' SECOND END AS tpep_dropoff_datetime,
    CASE WHEN blank THEN NULL WHEN kind = 400 THEN 0.0::DOUBLE ELSE CAST(1 + event_id % 5 AS DOUBLE) END AS passenger_count,
    CASE WHEN kind = 25 THEN NULL WHEN kind = 200 THEN 0.0::DOUBLE WHEN kind = 300 THEN 1234.5::DOUBLE
         ELSE mph * dur_s / 3600.0::DOUBLE END AS trip_distance,
    CASE WHEN blank THEN NULL ELSE 1.0::DOUBLE END AS RatecodeID,
    CAST(1 + user_id % 265 AS INT) AS PULocationID,
    CAST(1 + (event_id * 17) % 265 AS INT) AS DOLocationID,
    1 + event_id % 4 AS payment_type,
    CASE WHEN kind = 100 THEN -7.25::DOUBLE ELSE 3.0::DOUBLE + dur_s / 60.0::DOUBLE END AS fare_amount,
    value / 10.0::DOUBLE AS tip_amount,
    0.0::DOUBLE AS tolls_amount,
    CASE WHEN kind = 575 THEN -1.0::DOUBLE ELSE 4.0::DOUBLE + dur_s / 60.0::DOUBLE + value / 10.0::DOUBLE END AS total_amount,
    CASE WHEN blank THEN NULL ELSE 2.5::DOUBLE END AS congestion_surcharge,
    CASE WHEN blank THEN NULL ELSE 0.0::DOUBLE END AS airport_fee
  FROM base
), trips AS (
  SELECT * FROM once
  UNION ALL
  SELECT * FROM once WHERE EXTRACT(SECOND FROM tpep_pickup_datetime) < 1 AND VendorID = 1
)"""


def trips_path(spark: SparkSession, sf_dir: str) -> str:
    """The stand-in as parquet in the shared folder, written once per session: the source of the queries."""
    def write() -> str:
        path = fresh_path(spark, "trips")
        trips_from_events(spark, sf_dir).write.parquet(path)
        return path

    return once_per_session(spark, f"trips {sf_dir}", write)


def cleaned(spark: SparkSession, sf_dir: str) -> Prepared:
    """The prepared table, written once per session: the input of all consumers."""
    return once_per_session(
        spark, f"cleaned {sf_dir}", lambda: prepare_file(spark, trips_path(spark, sf_dir)))
