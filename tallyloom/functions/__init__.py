"""Scalar functions, as Columns over Columns."""
