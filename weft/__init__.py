"""weft: frequent-pattern and sequential-pattern mining on Spark DataFrames."""
