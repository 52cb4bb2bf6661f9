"""Portfolio analytics on Spark: every operator maps DataFrames (or Columns) to DataFrames."""

__version__ = "0.1.0"
