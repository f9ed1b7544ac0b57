"""Operators of a training-data pipeline (secrets, dedup, filters, tokenizers, quality).

Nothing outside this subpackage imports it; ``corpus_pipeline.py`` and the tests in
``tests/llm`` belong to it.
"""
