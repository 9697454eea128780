"""Sales-trend analytics and scoring on Spark DataFrames."""
