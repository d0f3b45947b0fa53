"""Operators that turn a planned table into a DataFrame."""
