"""linkweave: entity resolution and record linkage on Spark DataFrames."""
