"""The operators' queries and their SQL, added to the entry file when this imports."""

from __future__ import annotations

from prepforge.llm.embeddings import OP5_SQL, op5_embeddings
from prepforge.llm.filter_audit import OP12_SQL, op12_filter_audit
from prepforge.llm.hpylm import op3_hpylm
from prepforge.llm.imatch import OP11_SQL, op11_imatch
from prepforge.llm.langid import op4_langid
from prepforge.llm.mixing import OP8_SQL, op8_mixing
from prepforge.llm.packing import op7_packing
from prepforge.llm.quality import op1_quality
from prepforge.llm.secrets import op9_secrets
from prepforge.llm.simhash import op6_simhash
from prepforge.llm.spelling import OP13_SQL, op13_spelling
from prepforge.llm.token_files import op2_simple8b
from prepforge.llm.topk import OP10_SQL, op10_topk

QUERIES = {
    "op3_hpylm": op3_hpylm,
    "op10_topk": op10_topk,
    "op1_quality": op1_quality,
    "op4_langid": op4_langid,
    "op9_secrets": op9_secrets,
    "op2_simple8b": op2_simple8b,
    "op7_packing": op7_packing,
    "op5_embeddings": op5_embeddings,
    "op6_simhash": op6_simhash,
    "op8_mixing": op8_mixing,
    "op11_imatch": op11_imatch,
    "op12_filter_audit": op12_filter_audit,
    "op13_spelling": op13_spelling,
}

ORACLES = {
    "op10_topk": OP10_SQL,
    "op5_embeddings": OP5_SQL,
    "op8_mixing": OP8_SQL,
    "op11_imatch": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_spelling": OP13_SQL,
}
