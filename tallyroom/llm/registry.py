"""Queries of the operators, and the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from tallyroom.llm.chat_format import OP8_SQL, op8_chat_format
from tallyroom.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from tallyroom.llm.imatch import op7_imatch
from tallyroom.llm.jaccard_join import OP2_SQL, op2_jaccard_join
from tallyroom.llm.license_scan import OP9_SQL, op9_license_scan
from tallyroom.llm.merkle import OP13_SQL, op13_merkle_manifest
from tallyroom.llm.packing import op5_packing
from tallyroom.llm.personal_data import op6_personal_data
from tallyroom.llm.quality import op1_quality
from tallyroom.llm.secret_scan import OP3_SQL, op3_secret_scan
from tallyroom.llm.segments import OP11_SQL, op11_segment_resampling
from tallyroom.llm.source_mix import OP4_SQL, op4_source_mix
from tallyroom.llm.weak_rules import OP12_SQL, op12_weak_rules

QUERIES = {
    "op1_quality": op1_quality,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_secret_scan": op3_secret_scan,
    "op4_source_mix": op4_source_mix,
    "op5_packing": op5_packing,
    "op6_personal_data": op6_personal_data,
    "op7_imatch": op7_imatch,
    "op8_chat_format": op8_chat_format,
    "op9_license_scan": op9_license_scan,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_segment_resampling": op11_segment_resampling,
    "op12_weak_rules": op12_weak_rules,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL = {
    "op2_jaccard_join": OP2_SQL,
    "op3_secret_scan": OP3_SQL,
    "op4_source_mix": OP4_SQL,
    "op8_chat_format": OP8_SQL,
    "op9_license_scan": OP9_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op11_segment_resampling": OP11_SQL,
    "op12_weak_rules": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
