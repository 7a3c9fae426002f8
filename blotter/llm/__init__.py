"""Operators of a training-data pipeline, their queries and their SQL.

Nothing else in the library imports this subpackage.
"""
