"""The queries of the training-data operators and the SQL for those that SQL can express."""

from __future__ import annotations

from rollweave.llm import oracles, pipeline
from rollweave.llm.alignment import op11_alignment
from rollweave.llm.bpetree import op12_bpe_tree
from rollweave.llm.exactdedup import op3_exact_dedup
from rollweave.llm.htmltext import op1_html_extraction
from rollweave.llm.langid import op9_language_id
from rollweave.llm.mixing import op4_source_mixing
from rollweave.llm.neardedup import op6_near_dedup
from rollweave.llm.pieces import op7_sentencepiece
from rollweave.llm.quality import op5_quality
from rollweave.llm.tokenfiles import op2_token_files
from rollweave.llm.topk import op8_exact_topk
from rollweave.llm.urlfilter import op10_url_filters
from rollweave.llm.vectorcodes import op13_vector_codes


def queries() -> dict:
    return {
        "op1_html_extraction": op1_html_extraction,
        "op2_token_files": op2_token_files,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_source_mixing": op4_source_mixing,
        "op5_quality": op5_quality,
        "op6_near_dedup": op6_near_dedup,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_exact_topk": op8_exact_topk,
        "op9_language_id": op9_language_id,
        "op10_url_filters": op10_url_filters,
        "op11_alignment": op11_alignment,
        "op12_bpe_tree": op12_bpe_tree,
        "op13_vector_codes": op13_vector_codes,
        "pipeline": pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
