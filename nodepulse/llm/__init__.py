"""Operators of a training-data pipeline: one module for each operator.

Nothing else in the library imports this package.
"""
