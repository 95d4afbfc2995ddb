"""The registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from millrace.llm import (archives, decontamination, filteraudit, langid, languagemodel, linededup, neardup, qualitynet, qualityrules,
                          subwords, tokencounts, turntrie, wrappers)

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_decontamination": decontamination.op1_decontamination,
    "op2_language": langid.op2_language,
    "op3_near_duplicates": neardup.op3_near_duplicates,
    "op4_quality": qualitynet.op4_quality,
    "op9_quality_rules": qualityrules.op9_quality_rules,
    "op10_line_dedup": linededup.op10_line_dedup,
    "op5_main_text": wrappers.op5_main_text,
    "op8_token_counts": tokencounts.op8_token_counts,
    "op6_language_model": languagemodel.op6_language_model,
    "op7_subwords": subwords.op7_subwords,
    "op11_filter_audit": filteraudit.op11_filter_audit,
    "op12_warc": archives.op12_warc,
    "op13_conversation_trie": turntrie.op13_conversation_trie,
}

ORACLES: dict[str, str] = {
    "op1_decontamination": decontamination.OP1_SQL,
    "op3_near_duplicates": neardup.OP3_SQL,
    "op10_line_dedup": linededup.OP10_SQL,
    "op11_filter_audit": filteraudit.OP11_SQL,
    "op12_warc": archives.OP12_SQL,
    "op13_conversation_trie": turntrie.OP13_SQL,
}
