"""Tarazi: multi-retailer price analytics as Spark DataFrame plans."""
