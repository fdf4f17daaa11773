"""Contest analytics on Spark: two-sided contests over time as DataFrame operators."""
