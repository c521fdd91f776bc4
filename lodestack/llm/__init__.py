"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  The queries over these
operators are in ``queries.py``, their SQL counterparts in ``oracles.py``.
"""
