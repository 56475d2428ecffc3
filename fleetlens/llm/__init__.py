"""Operators for preparing language-model training text.

Nothing outside this folder imports it.  Every operator takes DataFrames and
returns a DataFrame; the contract queries built on them are in ``queries``.
"""
