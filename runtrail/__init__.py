"""Run-log analytics on Spark.

Every operator takes and returns DataFrames (or Columns) and is built from
Spark's own expressions, so nothing here leaves the JVM.
"""
