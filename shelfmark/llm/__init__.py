"""Corpus preparation for training data: ten operators, one module each.

Every module has a general operator and a thin ``opN_<name>`` query. Nothing
outside this package imports it.
"""
