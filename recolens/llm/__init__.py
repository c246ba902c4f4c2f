"""Operators for training-data pipelines. Nothing outside this folder imports it, except the
entry module (when it is present) and `corpus_pipeline.py`."""
