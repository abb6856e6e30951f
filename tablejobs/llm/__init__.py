"""Operators for preparing language-model training data.

One module per operator; ``queries`` registers the thin ``opN_*`` queries over
the supplied tables. Nothing outside this package imports it.
"""
