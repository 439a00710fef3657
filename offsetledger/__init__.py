"""Move a partitioned message log into a bucketed Parquet table and prove nothing was lost.

Everything here is a function from DataFrames to DataFrames; see README.md.
"""
