"""Floor-plan analytics on Spark: plans, findings, geometry and packages as DataFrames."""
