"""Operators for preparing large text corpora, one module per operator.

Nothing outside this subpackage imports it; its queries are in ``catalog``.
"""
