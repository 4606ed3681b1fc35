"""Registered queries: each reads the given tables and has its SQL counterpart."""
