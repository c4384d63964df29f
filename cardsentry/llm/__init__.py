"""Operators of a training-data pipeline (tokens, decontamination, near-dedup,
mixing, quality, suffix arrays, sharding, language model, WARC, toxicity).

Nothing outside this subpackage imports it; ``queries`` registers one query per
operator.
"""
