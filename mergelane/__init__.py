"""Table operators for integrating messy partner data with Spark DataFrames."""
