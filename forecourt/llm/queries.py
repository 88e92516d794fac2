"""Registered queries of this subpackage, each over its whole table, and their SQL counterparts."""

from __future__ import annotations

from forecourt.llm import oracles
from forecourt.llm.centroids import CENTROIDS_SQL, q_centroids
from forecourt.llm.chosen_path import q_near_duplicates
from forecourt.llm.conversation_repair import q_conversation_repair
from forecourt.llm.decontaminate import q_decontamination
from forecourt.llm.language_id import q_language_id, q_page_language
from forecourt.llm.license_scan import q_license_scan
from forecourt.llm.line_dedup import LINE_DEDUP_SQL, q_line_dedup
from forecourt.llm.multiset_hash import q_fingerprints
from forecourt.llm.packing import q_packing
from forecourt.llm.sanitise import q_personal_data
from forecourt.llm.secret_ledger import q_secret_scan
from forecourt.llm.token_counts import q_token_counts
from forecourt.llm.toxicity import q_toxicity

QUERIES = {
    "op1_line_dedup": q_line_dedup,
    "op2_packing": q_packing,
    "op3_license_scan": q_license_scan,
    "op4_near_duplicates": q_near_duplicates,
    "op5_personal_data": q_personal_data,
    "op6_decontamination": q_decontamination,
    "op7_fingerprints": q_fingerprints,
    "op8_token_counts": q_token_counts,
    "op9_language_id": q_language_id,
    "op10_secret_scan": q_secret_scan,
    "op11_centroids": q_centroids,
    "op12_toxicity": q_toxicity,
    "op13_conversation_repair": q_conversation_repair,
    "llm_page_language": q_page_language,
}

ORACLES = {
    "op1_line_dedup": LINE_DEDUP_SQL,
    "op4_near_duplicates": oracles.NEAR_DUPLICATES,
    "op5_personal_data": oracles.PERSONAL_DATA,
    "op10_secret_scan": oracles.SECRET_SCAN,
    "op11_centroids": CENTROIDS_SQL,
}
