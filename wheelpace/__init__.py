"""Trip-speed analytics on Spark DataFrames."""

from wheelpace.config import DEFAULT, TripConfig

__all__ = ["DEFAULT", "TripConfig"]
