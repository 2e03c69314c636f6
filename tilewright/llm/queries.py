"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import best_fit, conversation, exact_dedup, lm_score, mixing, near_dup, packing, pii, quality, quality_rules, ranked_search, toxicity, url_filter


def queries() -> dict:
    found = (
        exact_dedup.op1_exact_dedup, url_filter.op2_url_filter, quality_rules.op3_quality_rules, mixing.op4_mixing, near_dup.op5_near_duplicates,
        lm_score.op6_lm_score, quality.op7_quality, packing.op8_packing, pii.op9_pii, toxicity.op10_toxicity,
        best_fit.op11_best_fit, ranked_search.op12_ranked_search, conversation.op13_conversations,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": exact_dedup.OP1_SQL, "op2_url_filter": url_filter.OP2_SQL, "op3_quality_rules": quality_rules.OP3_SQL, "op4_mixing": mixing.OP4_SQL, "op12_ranked_search": ranked_search.OP12_SQL, "op13_conversations": conversation.OP13_SQL}
