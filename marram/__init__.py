"""Analytics operators for revision histories, text, projections and rasters.

Every operator is a plain function from DataFrames to a DataFrame: lazy, built
from Spark's own expressions, joins, aggregates and windows.
"""
