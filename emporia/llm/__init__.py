"""Operators of a training-data pipeline over a corpus of documents.

One module per operator, plus ``queries`` (the registered queries) and two
helpers: ``common`` (Arrow batches, staged tables) and ``graph`` (connected
components). Nothing outside this subpackage imports it.
"""
