"""Operators for preparing training data, the queries over the given tables, and nothing the rest of the library needs."""
