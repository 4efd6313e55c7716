"""Operators of a training-data pipeline: token counts, repeat removal, exact
vector search, BPE, HTML extraction, source mixing, near-duplicate, quality,
exact-duplicate and fuzzy-line stages.

Nothing else in the library imports this subpackage. ``queries.py`` holds the
thin registered queries, ``oracle.py`` the SQL of those that SQL can express.
"""
