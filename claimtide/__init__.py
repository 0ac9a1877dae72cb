"""Claim monitoring on Spark: DataFrame in, DataFrame out."""
