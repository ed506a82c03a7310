"""Operators for large-scale training-data pipelines.

Nothing outside this package (and ``corpus_pipeline.py``) imports it. Each module is one
operator with a general interface; ``queries.py`` holds the thin registered queries.
"""
