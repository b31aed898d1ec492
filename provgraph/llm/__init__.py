"""Operators for preparing training text at scale, each a set of Spark jobs.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
