"""Operators: DataFrame in, DataFrame out, rows keyed by explicit ids."""
