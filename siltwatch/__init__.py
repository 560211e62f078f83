"""DNS log threat analytics on Spark DataFrames and Structured Streaming."""
