"""Operators for preparing large text and vector collections.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
