"""textloom: corpus building and analytics on Spark DataFrames."""
