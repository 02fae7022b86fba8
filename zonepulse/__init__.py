"""Mobility analytics on Spark DataFrames: cleaning, profiling, zone volume and event impact."""
