"""corpuslab: text analytics on Spark DataFrames.

Sub-packages
------------
functions   column expressions over strings and arrays (no shuffle)
operators   DataFrame -> DataFrame steps (joins, aggregates, windows, models)
sources     readers and writers
streaming   Structured Streaming jobs
plans       named queries built from the operators
"""
