"""Relational and feature operators, each a function from DataFrames to DataFrames."""
