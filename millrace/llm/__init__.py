"""Operators for preparing language-model training data.

Nothing else in the package imports this subpackage. Every operator takes a
DataFrame plus column names and returns a DataFrame; ``queries`` holds the
thin per-contract wrappers over the ``documents`` table.
"""
