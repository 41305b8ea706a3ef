"""The registered queries of this subpackage."""

from __future__ import annotations

from clickflow.llm.bpe import op3_byte_bpe
from clickflow.llm.language_id import op5_language_id
from clickflow.llm.line_dedup import op2_line_dedup
from clickflow.llm.merkle import OP11_SQL, op11_merkle_manifest
from clickflow.llm.near_dedup import op6_near_dedup
from clickflow.llm.packing import op9_packing
from clickflow.llm.quality_lm import op8_quality_classifier
from clickflow.llm.quality_rules import OP1_SQL, op1_quality_rules
from clickflow.llm.secrets import op12_secret_scans
from clickflow.llm.spelling import OP13_SQL, op13_spelling_variants
from clickflow.llm.token_files import op10_token_files
from clickflow.llm.vector_search import op7_vector_search
from clickflow.llm.warc import OP4_SQL, op4_warc

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_line_dedup": op2_line_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_warc": op4_warc,
    "op5_language_id": op5_language_id,
    "op6_near_dedup": op6_near_dedup,
    "op7_vector_search": op7_vector_search,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_packing": op9_packing,
    "op10_token_files": op10_token_files,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_secret_scans": op12_secret_scans,
    "op13_spelling_variants": op13_spelling_variants,
}

#: DuckDB SQL where SQL can express a query.
ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": OP1_SQL,
    "op4_warc": OP4_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op13_spelling_variants": OP13_SQL,
}
