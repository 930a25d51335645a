"""covey: observation analytics on Spark DataFrames."""
