"""Operators a training-data pipeline needs, and their registered queries.

Nothing else in the library imports this subpackage.
"""
