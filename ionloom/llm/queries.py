"""Queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from ionloom.llm import chat_format, quality_rules, token_counts, url_templates
from ionloom.llm.chat_format import op6_chat_format
from ionloom.llm.decontaminate import op4_decontamination
from ionloom.llm.language_id import op1_language_id
from ionloom.llm.ngram_join import op2_ngram_join
from ionloom.llm.packing import op3_packing
from ionloom.llm.quality import op5_quality
from ionloom.llm.quality_rules import op7_quality_rules
from ionloom.llm.repair import op13_repair
from ionloom.llm.spelling import op12_spelling
from ionloom.llm.suffix_dedup import op10_suffix_dedup
from ionloom.llm.token_counts import op8_token_counts
from ionloom.llm.toxicity import op9_toxicity
from ionloom.llm.url_templates import op11_url_templates

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_ngram_join": op2_ngram_join,
    "op3_packing": op3_packing,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_chat_format": op6_chat_format,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_counts": op8_token_counts,
    "op9_toxicity": op9_toxicity,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_url_templates": op11_url_templates,
    "op12_spelling": op12_spelling,
    "op13_repair": op13_repair,
    "rules_base_columns": quality_rules.rules_base_columns,
    "pretoken_counts": token_counts.pretoken_counts,
    "url_rules": url_templates.url_rules,
}

ORACLES: dict[str, str] = {
    "op6_chat_format": chat_format.ORACLE,
    "rules_base_columns": quality_rules.BASE_ORACLE,
    "pretoken_counts": token_counts.PRETOKEN_ORACLE,
    "url_rules": url_templates.RULES_ORACLE,
}
