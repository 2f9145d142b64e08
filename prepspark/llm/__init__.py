"""Operators for large text corpora, each written for one Spark job graph.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
