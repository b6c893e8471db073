"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from wordloom.llm import (
    decontaminate,
    html_text,
    mixing,
    near_dedup,
    ordinal_quality,
    periodic_runs,
    quality_rules,
    secrets,
    sentencepiece_codec,
    suffix_dedup,
    tokenizer_alignment,
    url_filter,
    warc,
)

QUERIES = {
    "op1_secret_scan": secrets.query,
    "op2_sentencepiece": sentencepiece_codec.query,
    "op3_quality_outliers": quality_rules.query,
    "op4_warc": warc.query,
    "op5_url_filter": url_filter.query,
    "op6_decontamination": decontaminate.query,
    "op7_setsketch_near_dedup": near_dedup.query,
    "op8_suffix_array_dedup": suffix_dedup.query,
    "op9_html_templates": html_text.query,
    "op10_ordinal_quality": ordinal_quality.query,
    "op11_periodic_runs": periodic_runs.query,
    "op12_tokenizer_alignment": tokenizer_alignment.query,
    "op13_source_mixing": mixing.query,
}

ORACLE: dict[str, str] = {
    "op1_secret_scan": secrets.ORACLE,
    "op4_warc": warc.ORACLE,
}
