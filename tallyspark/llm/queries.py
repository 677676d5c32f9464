"""The corpus operators' queries and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from . import (byte_bpe, collocations, decontaminate, jaccard_join, langid, language_model, lexical_search,
               personal_data, pivot_search, quality, secrets, toxicity, url_filter)

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_langid": langid.op4_langid,
    "op5_pivot_search": pivot_search.op5_pivot_search,
    "op6_secret_scan": secrets.op6_secret_scan,
    "op7_quality": quality.op7_quality,
    "op8_language_model": language_model.op8_language_model,
    "op9_byte_bpe": byte_bpe.op9_byte_bpe,
    "op10_jaccard_join": jaccard_join.op10_jaccard_join,
    "op11_personal_data": personal_data.op11_personal_data,
    "op12_collocations": collocations.op12_collocations,
    "op13_lexical_search": lexical_search.op13_lexical_search,
}

ORACLES = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op3_url_filter": url_filter.ORACLE,
    "op5_pivot_search": pivot_search.ORACLE,
    "op6_secret_scan": secrets.ORACLE,
    "op10_jaccard_join": jaccard_join.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_lexical_search": lexical_search.ORACLE,
}
