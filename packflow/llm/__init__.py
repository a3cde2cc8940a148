"""Operators for preparing language-model training data, as Spark jobs.

One module per operator; ``catalog`` binds them to the given tables. Nothing
outside this package imports it.
"""
