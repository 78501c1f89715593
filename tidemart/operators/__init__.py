"""Operators: DataFrame in, DataFrame out, for batch and (where noted) streams."""
