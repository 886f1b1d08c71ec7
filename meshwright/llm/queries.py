"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from meshwright.llm.op1_language import op1_language_fusion
from meshwright.llm.op2_quality import op2_quality_fm
from meshwright.llm.op3_secrets import op3_secret_scan
from meshwright.llm.op4_search import op4_bm25_block_max_wand
from meshwright.llm.op5_packing import op5_pack_ffd
from meshwright.llm.op6_embeddings import op6_embedding_pigeonhole
from meshwright.llm.op7_chat import op7_chat_quotes
from meshwright.llm.op8_simhash import op8_simhash_golay
from meshwright.llm.op9_toxicity import op9_toxicity_bigru
from meshwright.llm.op10_mixing import op10_soft_mixing

QUERIES = {
    f.__name__: f
    for f in (
        op1_language_fusion, op2_quality_fm, op3_secret_scan, op4_bm25_block_max_wand, op5_pack_ffd,
        op6_embedding_pigeonhole, op7_chat_quotes, op8_simhash_golay, op9_toxicity_bigru, op10_soft_mixing,
    )
}

#: Those that SQL can express on whole tables.
ORACLE: dict[str, str] = {}
