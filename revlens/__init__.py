"""Review-text analytics on Spark: features, vectors, models and evaluation tables."""
