"""Lenses: named queries over the base tables, and the registry that holds them."""
