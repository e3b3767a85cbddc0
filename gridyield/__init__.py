"""Gridded solar and wind capacity-factor analytics on Spark DataFrames.

One row per (grid cell, timestamp); NULL is the only missing marker.
Kernels are native ``Column`` expressions, jobs are DataFrame plans.
"""

__version__ = "0.1.0"
