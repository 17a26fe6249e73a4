"""Queries of the numbered operators and their SQL, for the driver's entry."""

from __future__ import annotations

from eventlens.llm import (chat, collocations, decontaminate, language_id, line_dedup, merkle, near_dup, packing, pii, substring_dedup,
                           token_counts, topk, warc)

QUERIES = {f.__name__: f for f in (
    line_dedup.op1_line_dedup, token_counts.op2_token_counts, packing.op3_packing, near_dup.op4_near_duplicates, topk.op5_topk_search,
    decontaminate.op6_decontaminate, substring_dedup.op7_substring_dedup, language_id.op8_language_id, chat.op9_chat_format,
    warc.op10_warc_derivatives, merkle.op11_merkle_manifest, pii.op12_personal_data, collocations.op13_collocations)}
SQL = {"op1_line_dedup": line_dedup.OP1_SQL, "op4_near_duplicates": near_dup.OP4_SQL, "op7_substring_dedup": substring_dedup.OP7_SQL,
       "op9_chat_format": chat.OP9_SQL, "op11_merkle_manifest": merkle.OP11_SQL, "op12_personal_data": pii.OP12_SQL,
       "op13_collocations": collocations.OP13_SQL}
