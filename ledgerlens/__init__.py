"""Transaction risk analytics on Spark: profiling, segments, rules, anomalies, cube."""
