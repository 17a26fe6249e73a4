"""Training-data operators (dedup, decontamination, tokens, packing, search, formats).

Self-contained: nothing outside this folder, ``corpus_pipeline.py`` and
``tests/llm`` imports it.
"""
