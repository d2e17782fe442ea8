"""Operators for preparing large text and vector corpora, and the queries that run them.

Nothing else in the library imports this subpackage.
"""
