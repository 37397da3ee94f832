"""Campaign-list and lending-funnel analytics on Spark DataFrames."""
