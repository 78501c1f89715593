"""Layered e-commerce warehouse on Spark: raw -> detail -> wide -> summary."""
