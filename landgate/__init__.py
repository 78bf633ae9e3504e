"""Landing, quality gates and metric queries on Spark DataFrames."""
