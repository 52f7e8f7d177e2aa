"""Order-preserving bucket numbers for doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# |ln(x)| of every finite double other than zero is below this, so the parts for negative numbers,
# zero and positive numbers never overlap.
_LOG_BOUND = 800.0


def bucket(value: Column, bits: int) -> Column:
    """Number of the bucket of ``value``: never falls while ``value`` rises.

    Each bucket spans a relative width of 2**-bits. With 12 bits a whole column falls into some
    thousand buckets; with 32 bits a bucket holds at most about 2**21 different doubles, because
    a double has 52 bits of fraction.
    """
    log = F.least(F.log(F.abs(value)), F.lit(_LOG_BOUND))
    size = F.floor((log + _LOG_BOUND) * float(2 ** bits)) + 1
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0).cast("long"))
