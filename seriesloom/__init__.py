"""Product time-series analytics on Spark DataFrames."""
