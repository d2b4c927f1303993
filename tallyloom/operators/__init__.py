"""Relational operators that are more than one built-in step, as functions from DataFrames to DataFrames."""
