"""Hydrometeorological catalogue analytics as plain PySpark DataFrame operators.

Everything here is a function from DataFrames (or Columns) to DataFrames (or
Columns).  Nothing holds state and nothing collects: Catalyst sees one logical
plan from the scan to the sink.
"""

__version__ = "0.1.0"
