"""Stream and table operators for event data, written as plain PySpark DataFrame functions.

Every operator takes DataFrames and returns DataFrames, so the same code serves a
static table and a Structured Streaming source.
"""
