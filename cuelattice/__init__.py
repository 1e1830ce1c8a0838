"""Time-aligned transcript and caption analytics on Spark DataFrames."""
