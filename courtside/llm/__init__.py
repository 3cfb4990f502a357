"""Operators for preparing language-model training data, their queries, and nothing the rest of the library needs."""
