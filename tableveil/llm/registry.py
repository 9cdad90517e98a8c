"""Every query of this subpackage, and the SQL of those that SQL can express."""

from . import chat_format, decontaminate, fill_in_middle, hard_negatives, language_id, lm_score, near_dedup, quality_classifier, quality_rules, sim_hash, source_mix, token_counts, web_archive

MODULES = (token_counts, decontaminate, language_id, lm_score, source_mix, near_dedup, quality_rules, web_archive, chat_format, quality_classifier, sim_hash, fill_in_middle, hard_negatives)


def queries() -> dict:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
