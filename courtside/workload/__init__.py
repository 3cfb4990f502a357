"""Registered queries on the given tables, each with its SQL counterpart."""
