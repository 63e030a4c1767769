"""logtide: operational log analytics on Spark DataFrames and Structured Streaming."""
