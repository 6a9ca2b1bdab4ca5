"""Operators of a training-data pipeline over ``documents``.

One module per operator; ``queries.py`` registers the eleven queries.
Nothing else in the library imports this subpackage.
"""
