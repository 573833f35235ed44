"""Queries of this subpackage and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from quire.llm.audit import OP12_SQL, op12_filter_audit
from quire.llm.bpe import op2_bpe_round_trip
from quire.llm.decontaminate import op3_decontaminate
from quire.llm.fingerprints import op5_fingerprints
from quire.llm.language_id import op7_language_id
from quire.llm.licenses import OP11_SQL, op11_licenses
from quire.llm.quality import op10_quality
from quire.llm.quotes import op6_quotation_linking
from quire.llm.resample import op13_resample
from quire.llm.sharding import op1_sharding
from quire.llm.simhash import op9_simhash
from quire.llm.substring import op4_substring_dedup
from quire.llm.tokens import op8_token_counts

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_decontaminate": op3_decontaminate,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_quotation_linking": op6_quotation_linking,
    "op7_language_id": op7_language_id,
    "op8_token_counts": op8_token_counts,
    "op9_simhash": op9_simhash,
    "op10_quality": op10_quality,
    "op11_licenses": op11_licenses,
    "op12_filter_audit": op12_filter_audit,
    "op13_resample": op13_resample,
}

ORACLE_SQL: dict[str, str] = {"op11_licenses": OP11_SQL, "op12_filter_audit": OP12_SQL}
