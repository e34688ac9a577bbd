from tessera.functions.text import (
    anagram_key, field, joined_sorted, lines_of, pair_digest, pair_text,
    split_fields, word_tokens,
)
from tessera.functions.time import as_of_instant, lookback_start, ts_type

__all__ = [
    "anagram_key", "field", "joined_sorted", "lines_of", "pair_digest",
    "pair_text", "split_fields", "word_tokens", "as_of_instant",
    "lookback_start", "ts_type",
]
