"""Court-docket analytics on Spark DataFrames."""
