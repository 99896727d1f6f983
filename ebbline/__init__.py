"""User-activity and churn analytics on Spark DataFrames."""
