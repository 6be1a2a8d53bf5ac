"""Operators for large-scale training-data preparation.

One module per operator, one ``queries`` module that binds them to the
tables. Nothing else in the library imports this subpackage.
"""
