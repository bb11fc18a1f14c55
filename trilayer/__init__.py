"""Medallion analytics as Spark DataFrame operators.

Every function takes DataFrames (or Columns) and returns DataFrames (or Columns).  Work starts only at a sink, or where a
docstring says that a small summary is fetched.
"""
