"""Relational and model operators, each a DataFrame -> DataFrame function."""
