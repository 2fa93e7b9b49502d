"""Operators for preparing training text, and the queries over the given tables that apply them."""
