from tessera.operators.choices import choices_over_time, price_steps
from tessera.operators.daily_sets import affected_over_ranges, daily_sets, dense_ids, distinct_over_ranges
from tessera.operators.matching import (
    active_at, option_expand, pair_digest_match, ttl_exclude,
)
from tessera.operators.ranks import global_rank, key_rank, word_rank
from tessera.operators.series import (
    cheapest_under_limit, choice_severity, failure_streak, option_prices,
    severity, top_n_rows, trailing_topn_avg,
)
from tessera.operators.shares import (
    affected_share, format_share_lines, key_counts, topk_share, value_share,
)
from tessera.operators.sliding import trailing_topn_series
from tessera.operators.text import (
    anagram_groups, anagram_members, format_ranked, line_count, top_words, word_count,
    word_count_topk, words,
)

__all__ = [
    "active_at", "option_expand", "pair_digest_match", "ttl_exclude",
    "cheapest_under_limit", "choice_severity", "failure_streak", "option_prices",
    "severity", "top_n_rows", "trailing_topn_avg", "affected_share", "key_counts",
    "topk_share", "value_share", "format_share_lines", "anagram_groups", "anagram_members", "format_ranked", "line_count",
    "global_rank", "key_rank", "word_rank", "trailing_topn_series",
    "choices_over_time", "price_steps", "affected_over_ranges", "daily_sets", "dense_ids", "distinct_over_ranges", "top_words", "word_count", "word_count_topk", "words",
]
