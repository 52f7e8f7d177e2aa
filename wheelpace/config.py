"""One frozen description of the trip table, the cleaning bounds and the analysis settings."""

from __future__ import annotations

from dataclasses import dataclass

# Names of the derived columns every consumer relies on.
DURATION = "duration_min"
SPEED = "average_speed_mph"
HOUR = "pickup_hour"
WEEKDAY = "pickup_dayofweek"
WEEKEND = "is_weekend"
RUSH = "is_rush_hour"
DERIVED = (DURATION, SPEED, HOUR, WEEKDAY, WEEKEND, RUSH)

# Names of the model columns.
SLOW = "slow_trip"
TIME_GROUP = "pickup_time_group"
ROUTE = "route_id"
FRIDAY = "is_friday"
MONDAY = "is_monday"


@dataclass(frozen=True)
class TripConfig:
    """Column names, null policy, bounds and analysis settings; pass a changed copy to re-aim the engine."""

    pickup: str = "tpep_pickup_datetime"
    dropoff: str = "tpep_dropoff_datetime"
    distance: str = "trip_distance"
    fare: str = "fare_amount"
    total: str = "total_amount"
    passengers: str = "passenger_count"
    pickup_zone: str = "PULocationID"
    dropoff_zone: str = "DOLocationID"

    # The table contract.
    required: tuple[str, ...] = (
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
        "RatecodeID", "PULocationID", "DOLocationID", "payment_type",
        "fare_amount", "tip_amount", "tolls_amount", "total_amount",
    )
    optional: tuple[str, ...] = (
        "VendorID", "extra", "mta_tax", "improvement_surcharge",
        "congestion_surcharge", "airport_fee", "Airport_fee", "cbd_congestion_fee",
    )
    critical: tuple[str, ...] = (
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance",
        "fare_amount", "PULocationID", "DOLocationID",
    )
    nullable: tuple[str, ...] = ("passenger_count",)
    numeric: tuple[str, ...] = (
        "trip_distance", DURATION, SPEED, "fare_amount", "tip_amount", "total_amount", "passenger_count",
    )

    # Hypotheses.
    rush_hours: tuple[int, ...] = (7, 8, 9, 16, 17, 18, 19)
    weekend_days: tuple[int, ...] = (5, 6)
    alpha: float = 0.05

    # Plausible ranges, both ends inclusive.
    fare_range: tuple[float, float] = (2.5, 500.0)
    distance_range: tuple[float, float] = (0.1, 100.0)
    duration_range: tuple[float, float] = (1.0, 360.0)
    speed_range: tuple[float, float] = (1.0, 80.0)
    passenger_range: tuple[int, int] = (1, 6)

    # Model. The last hour of each group of the day, in order.
    seed: int = 42
    test_share: float = 0.2
    slow_quantile: float = 0.25
    time_groups: tuple[tuple[str, int], ...] = (
        ("late_night", 5), ("morning_rush", 9), ("daytime", 15), ("evening_rush", 19), ("night", 23),
    )
    numeric_features: tuple[str, ...] = ("passenger_count",)
    categorical_features: tuple[str, ...] = (
        HOUR, WEEKDAY, TIME_GROUP, "PULocationID", "DOLocationID", ROUTE, WEEKEND, RUSH, FRIDAY, MONDAY,
    )
    learning_rate: float = 0.08
    max_rounds: int = 250
    max_leaves: int = 31
    l2: float = 1.0
    min_leaf_rows: int = 50
    validation_share: float = 0.1
    early_stop_gain: float = 1e-7
    patience: int = 20

    @property
    def raw(self) -> tuple[str, ...]:
        return self.required + self.optional


DEFAULT = TripConfig()
