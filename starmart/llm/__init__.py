"""Operators for preparing large text corpora (language-model training data).

One module per operator. ``queries`` holds the registered queries and their
SQL. Nothing outside this package imports it.
"""
