"""Operators for preparing training corpora.

Nothing else in the library imports this subpackage, so it can be removed
without touching the relational operators.
"""
