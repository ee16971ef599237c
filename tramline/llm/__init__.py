"""Operators of a training-data pipeline over ``documents``, ``pages``,
``benchmark``, ``labels`` and ``conversations``.

Nothing else in the library imports this package. Each operator is a module
with a general interface (a function from DataFrames to a DataFrame) and one
thin query ``opN_<name>`` that applies it to a whole table.
"""
