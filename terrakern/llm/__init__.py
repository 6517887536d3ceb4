"""Corpus-building operators for language-model training data.

Nothing outside this package imports it.  ``queries`` lists the registered
queries, ``oracles`` the SQL that some of them can be held against.
"""
