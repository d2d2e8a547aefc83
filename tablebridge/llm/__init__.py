"""Operators for preparing training data, and the queries that apply them to the driver tables.

Nothing outside this folder, `corpus_pipeline.py` and `tests/llm` imports it.
"""
