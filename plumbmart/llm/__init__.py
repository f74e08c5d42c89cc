"""Operators for preparing language-model training data, one module each.

Nothing else in the library imports this package. Column names that begin with
two underscores are the operators' own: tables given to them must not have such.
"""
