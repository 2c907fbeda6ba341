"""Operators: DataFrame in, DataFrame out, plus fit/transform pairs."""
