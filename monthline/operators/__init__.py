"""Operators: DataFrame in, DataFrame out. Nothing is written here."""
