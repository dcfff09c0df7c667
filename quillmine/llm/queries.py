"""The corpus operators as queries over the tables of a folder, and SQL for those that SQL can express."""

import corpus_pipeline

from . import codes, decontaminate, exact_dedup, language_model, licenses, line_dedup, mixture, near_dedup, phrases, quality, repeats, secrets, urls

QUERIES = {
    "op1_near_dedup": near_dedup.op1_near_dedup,
    "op2_url_filter": urls.op2_url_filter,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_quality": quality.op5_quality,
    "op6_licenses": licenses.op6_licenses,
    "op7_mixture": mixture.op7_mixture,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_lm_score": language_model.op9_lm_score,
    "op10_secrets": secrets.op10_secrets,
    "op11_vector_codes": codes.op11_vector_codes,
    "op12_phrases": phrases.op12_phrases,
    "op13_substring_dedup": repeats.op13_substring_dedup,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op3_line_dedup": line_dedup.OP3_SQL,
    "op4_decontaminate": decontaminate.OP4_SQL,
    "op8_exact_dedup": exact_dedup.OP8_SQL,
    "op11_vector_codes": codes.OP11_SQL,
    "op12_phrases": phrases.OP12_SQL,
    "op13_substring_dedup": repeats.OP13_SQL,
}
