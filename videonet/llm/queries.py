"""Imports the modules that register the operators' queries."""

from videonet.llm import (  # noqa: F401
    chat,
    collocations,
    exact_dedup,
    fill_in_middle,
    language_id,
    main_text,
    packing,
    quality_rules,
    sentencepiece_codec,
    simhash,
    token_counts,
    warc,
    word_bpe,
)
from videonet.llm.registry import ORACLE, QUERIES  # noqa: F401
