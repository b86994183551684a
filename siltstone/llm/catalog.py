"""Queries and SQL of the subpackage, as ``__spark_entry__`` registers them."""

from __future__ import annotations

from . import counting, decontaminate, exact_dedup, html_text, language, near_dedup, packing, phrases, pii, quality, ranking, secrets, toxicity


def queries() -> dict:
    return {
        "op1_quality_nbsvm": quality.op1_quality_nbsvm,
        "op2_best_fit_packing": packing.op2_best_fit_packing,
        "op3_minhash_near_dedup": near_dedup.op3_minhash_near_dedup,
        "op5_decontaminate": decontaminate.op5_decontaminate,
        "op4_secret_ownership": secrets.op4_secret_ownership,
        "op6_html_bilstm": html_text.op6_html_bilstm,
        "op7_toxicity_cnn": toxicity.op7_toxicity_cnn,
        "op8_pii_bilstm_crf": pii.op8_pii_bilstm_crf,
        "op9_language_ppm": language.op9_language_ppm,
        "op10_exact_dedup": exact_dedup.op10_exact_dedup,
        "op11_grouped_ties": ranking.op11_grouped_ties,
        "op12_token_counts": counting.op12_token_counts,
        "op13_phrases": phrases.op13_phrases,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_secret_ownership": secrets.SQL, "op10_exact_dedup": exact_dedup.SQL, "op11_grouped_ties": ranking.SQL, "op13_phrases": phrases.SQL}
