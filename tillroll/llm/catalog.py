"""The operators of this package as queries, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (
    decontamination,
    jaccard_join,
    language_id,
    language_model,
    line_dedup,
    mixing,
    quality,
    ranked_search,
    substring_dedup,
    token_output,
    topk_search,
    url_filters,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontamination.op1_decontamination,
    "op2_url_filters": url_filters.op2_url_filters,
    "op3_language_id": language_id.op3_language_id,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_lm_scoring": language_model.op5_lm_scoring,
    "op6_topk_search": topk_search.op6_topk_search,
    "op7_mixing": mixing.op7_mixing,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_token_output": token_output.op9_token_output,
    "op10_quality_classifier": quality.op10_quality_classifier,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_substring_dedup": substring_dedup.op12_substring_dedup,
    "op13_ranked_search": ranked_search.op13_ranked_search,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": decontamination.OP1_SQL,
    "op2_url_filters": url_filters.OP2_SQL,
    "op6_topk_search": topk_search.OP6_SQL,
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op12_substring_dedup": substring_dedup.OP12_SQL,
    "op13_ranked_search": ranked_search.OP13_SQL,
}
