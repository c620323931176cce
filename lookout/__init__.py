"""Observability analytics on Spark: spans, logs, meter samples, relations and profiles in, answers out.

Every operator is a function from DataFrames to DataFrames. Nothing here collects data to the driver.
"""
