"""Schedule-trend analytics on Spark DataFrames."""
