"""Queries of this subpackage, for the driver."""

from __future__ import annotations

from dockmill.llm import companions
from dockmill.llm.bpe import op6_bpe
from dockmill.llm.collocations import OP11_SQL, op11_collocations
from dockmill.llm.decontamination import OP7_SQL, op7_decontamination
from dockmill.llm.importance import OP13_SQL, op13_importance
from dockmill.llm.katz import BASE12_SQL, base12_lm, op12_lm
from dockmill.llm.langid import op8_langid
from dockmill.llm.neardup import OP2_SQL, op2_neardup
from dockmill.llm.pii import op5_pii
from dockmill.llm.quality import op10_quality
from dockmill.llm.sharding import op9_sharding
from dockmill.llm.substrings import OP3_SQL, op3_substrings
from dockmill.llm.urls import op4_urls
from dockmill.llm.warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_neardup": op2_neardup,
    "op3_substrings": op3_substrings,
    "op4_urls": op4_urls,
    "op5_pii": op5_pii,
    "op6_bpe": op6_bpe,
    "op7_decontamination": op7_decontamination,
    "op8_langid": op8_langid,
    "op9_sharding": op9_sharding,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_lm": op12_lm,
    "base12_lm": base12_lm,
    "op13_importance": op13_importance,
} | companions.QUERIES
ORACLES = {
    "op1_warc": OP1_SQL,
    "op2_neardup": OP2_SQL,
    "op3_substrings": OP3_SQL,
    "op7_decontamination": OP7_SQL,
    "op11_collocations": OP11_SQL,
    "base12_lm": BASE12_SQL,
    "op13_importance": OP13_SQL,
} | companions.ORACLES
