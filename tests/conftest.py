import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wheelpace.checks.standin import cleaned, trips_from_events, trips_path  # noqa: E402
from wheelpace.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")  # show all pushed filters
    yield session
    session.stop()


@pytest.fixture(scope="session")
def source_path(spark):
    return trips_path(spark, SF_DIR)


@pytest.fixture(scope="session")
def raw(spark):
    return trips_from_events(spark, SF_DIR)


@pytest.fixture(scope="session")
def prepared(spark):
    return cleaned(spark, SF_DIR)


@pytest.fixture
def trips(spark):
    """Build raw trips from a few fields; the rest gets a plausible value."""
    schema = ("tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, "
              "trip_distance double, RatecodeID double, PULocationID int, DOLocationID int, payment_type long, "
              "fare_amount double, tip_amount double, tolls_amount double, total_amount double")
    usual = {"tpep_pickup_datetime": "2026-05-10 08:00:00", "tpep_dropoff_datetime": "2026-05-10 08:20:00",
             "passenger_count": 1.0, "trip_distance": 3.0, "RatecodeID": 1.0, "PULocationID": 100,
             "DOLocationID": 200, "payment_type": 1, "fare_amount": 20.0, "tip_amount": 3.0,
             "tolls_amount": 0.0, "total_amount": 25.0}

    def build(*rows: dict):
        names = [f.split()[0] for f in schema.split(", ")]
        values = [tuple({**usual, **row}[n] for n in names) for row in rows]
        texts = ", ".join(n + (" string" if "datetime" in n else " " + t) for n, t in
                          (f.split() for f in schema.split(", ")))
        df = spark.createDataFrame(values, texts)
        return df.withColumns({c: df[c].cast("timestamp_ntz") for c in names if "datetime" in c})

    return build
