"""Text retrieval and link analysis on Spark DataFrames."""
