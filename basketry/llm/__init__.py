"""Operators for preparing training data: ten numbered operators and their queries.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
