"""tidemark: keyed time series, sparse snapshots and their news as Spark DataFrames."""
