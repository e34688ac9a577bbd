from tessera.streaming.exclusions import (
    read_stream, run_append_stream, start_append_stream, ttl_exclude_stream_df,
)
from tessera.streaming.failures import failure_streak_stream_df
from tessera.streaming.topk import read_topk, run_word_topk_stream, update_topk
from tessera.streaming.word_count import (
    read_word_counts, run_word_count_stream, start_word_count_stream, word_count_stream_df,
)

__all__ = [
    "failure_streak_stream_df", "read_stream", "read_topk", "read_word_counts", "run_append_stream", "run_word_count_stream",
    "run_word_topk_stream", "update_topk",
    "start_append_stream", "start_word_count_stream", "ttl_exclude_stream_df", "word_count_stream_df",
]
