"""Column expressions: time, speed and model features, buckets, the t-distribution."""
