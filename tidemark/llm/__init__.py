"""Operators of a training-data pipeline over large text and vector tables.

Every operator is a function from DataFrame to DataFrame with its own parameters; ``queries`` holds the thin
registered queries.  Nothing else in the library imports this package.
"""
