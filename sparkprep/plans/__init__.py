"""Operators put together: feature tables, training runs and the registered queries."""
