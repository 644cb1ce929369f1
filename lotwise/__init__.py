"""Daily trade-risk analytics over brokerage accounts, on Spark DataFrames."""
