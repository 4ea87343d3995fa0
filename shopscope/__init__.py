"""Batch customer analytics for e-commerce data, written as Spark DataFrame plans."""
