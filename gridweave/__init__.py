"""gridweave: daily grid cubes, causal features and risk scores on Spark DataFrames."""
