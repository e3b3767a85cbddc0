"""Queries over the driver tables and their independent SQL.

The driver tables hold no climate data. Test relations of the shape of the real tables are derived
from them by one SQL text each, valid in Spark and in DuckDB; the operators under test are the DataFrame
code of this package, the expected result is written as plain SQL.
"""
