"""Operators for large-scale training data: tokens, secrets, neighbours, near copies, quality,
shards, mixtures and toxicity. Nothing outside this folder and ``corpus_pipeline.py`` imports it."""
