"""Operators for preparing training text at corpus scale.

Nothing else in the library imports this subpackage.  ``queries.py`` holds the
thin registered queries, the other modules hold the operators.
"""
