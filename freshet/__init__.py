"""River time series analytics on Spark DataFrames."""
