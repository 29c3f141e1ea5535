"""Operators for large training-text corpora. Nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it."""
