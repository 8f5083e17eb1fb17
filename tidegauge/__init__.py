"""Telemetry and record ingestion on Spark DataFrames and Structured Streaming."""
