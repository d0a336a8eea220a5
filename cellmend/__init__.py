"""cellmend: judge and repair messy tabular data with Spark DataFrames.

Everything is a DataFrame -> DataFrame operator or a Column expression built
from Spark's own functions; no Python runs per row.
"""
