"""Operators for large-scale training-data pipelines.

One module per operator; ``queries.py`` registers one query per operator and
``words.py`` / ``tables.py`` hold the shared helpers. Nothing else in the library
imports this package.
"""
