"""Land-cover change analytics on Spark DataFrames."""
