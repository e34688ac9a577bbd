"""The queries of this subpackage and, where SQL can say it, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (
    bpe, conversations, exact_dedup, importance, language, mixing, neighbours, ngram_lm, sharding, simhash, substring_dedup,
    suffix_dedup, warc,
)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": sharding.op1_sharding,
    "op2_mixing": mixing.op2_mixing,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_language": language.op4_language,
    "op5_ngram_lm": ngram_lm.op5_ngram_lm,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_simhash": simhash.op7_simhash,
    "op8_bpe": bpe.op8_bpe,
    "op9_nearest": neighbours.op9_nearest,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_trie": conversations.op11_trie,
    "op12_importance": importance.op12_importance,
    "op13_warc": warc.op13_warc,
}

ORACLE: dict[str, str] = {
    "op2_mixing": mixing.ORACLE,
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op6_substring_dedup": substring_dedup.ORACLE,
    "op10_suffix_dedup": suffix_dedup.ORACLE,
    "op11_trie": conversations.ORACLE,
    "op13_warc": warc.ORACLE,
}
