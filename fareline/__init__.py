"""Fareline: ride analytics on Spark, from raw events to star schema and measures."""
