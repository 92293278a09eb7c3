"""Telemetry analytics on Spark: declarative operators over DataFrames."""
