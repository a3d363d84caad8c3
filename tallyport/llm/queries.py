"""The registered queries of this subpackage and their SQL where SQL can say it."""

from __future__ import annotations

from tallyport.llm import (ann, audit, decontaminate, langid, licences, linededup, lmscore, mixing, quality, runs, secrets, simhash,
                           substring)

QUERIES = {
    "op1_line_dedup": linededup.op1,
    "op2_simhash_near_dedup": simhash.op2,
    "op3_lm_scores": lmscore.op3,
    "op4_quality_classifier": quality.op4,
    "op5_nearest_neighbours": ann.op5,
    "op6_secret_scan": secrets.op6,
    "op7_substring_dedup": substring.op7,
    "op8_decontaminate": decontaminate.op8,
    "op9_licence_scan": licences.op9,
    "op10_mix_sources": mixing.op10,
    "op11_periodic_runs": runs.op11,
    "op12_filter_audit": audit.op12,
    "op13_language_id": langid.op13,
}

SQL = {
    "op1_line_dedup": linededup.OP1_SQL,
    "op7_substring_dedup": substring.OP7_SQL,
    "op8_decontaminate": decontaminate.OP8_SQL,
    "op10_mix_sources": mixing.OP10_SQL,
    "op12_filter_audit": audit.OP12_SQL,
}
