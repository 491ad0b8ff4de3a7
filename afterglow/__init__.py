"""afterglow: attention-decay analytics on Spark DataFrames."""
