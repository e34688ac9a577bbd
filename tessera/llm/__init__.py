"""Operators of a training-data pipeline: sharding, mixing, deduplication,
language identification, language-model scoring, tokenisation and nearest
neighbours. Nothing outside this subpackage imports it.
"""
