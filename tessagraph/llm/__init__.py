"""Operators on training data; nothing outside this package imports them."""
