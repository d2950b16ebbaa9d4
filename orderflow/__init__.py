"""Change capture and order loading on Spark DataFrames."""
