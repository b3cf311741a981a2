"""Operators for preparing text corpora, and the queries that apply them.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
