"""Operators of a training-data pipeline over a table of documents. Nothing else in the library imports this package.

Common rules, unless a docstring says otherwise: a NULL text counts as an empty one; rows with equal or NULL ids
are rows of their own; an empty table gives an empty result; further columns travel along or are left out,
and one that has the name of a result column gives way to it.
"""
