"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from quayside.llm.decontaminate import q_op4_decontaminate
from quayside.llm.fill_in_middle import ORACLE_OP11, q_op11_fill_in_middle
from quayside.llm.html_text import q_op3_html_text
from quayside.llm.licenses import q_op7_license_scan
from quayside.llm.merkle import ORACLE_OP13, q_op13_merkle_manifest
from quayside.llm.mixing import ORACLE_OP8, q_op8_mixing
from quayside.llm.packing import q_op12_packing
from quayside.llm.quality_model import q_op1_quality_model
from quayside.llm.quality_rules import ORACLE_OP9, q_op9_quality_rules
from quayside.llm.simhash import q_op6_simhash
from quayside.llm.substrings import ORACLE_OP2, q_op2_substring_dedup
from quayside.llm.token_files import q_op10_token_files
from quayside.llm.toxicity import q_op5_toxicity

QUERIES = {
    "op1_quality_model": q_op1_quality_model,
    "op2_substring_dedup": q_op2_substring_dedup,
    "op3_html_text": q_op3_html_text,
    "op4_decontaminate": q_op4_decontaminate,
    "op5_toxicity": q_op5_toxicity,
    "op6_simhash": q_op6_simhash,
    "op7_license_scan": q_op7_license_scan,
    "op8_mixing": q_op8_mixing,
    "op9_quality_rules": q_op9_quality_rules,
    "op10_token_files": q_op10_token_files,
    "op11_fill_in_middle": q_op11_fill_in_middle,
    "op12_packing": q_op12_packing,
    "op13_merkle_manifest": q_op13_merkle_manifest,
}

ORACLE_SQL = {
    "op2_substring_dedup": ORACLE_OP2,
    "op8_mixing": ORACLE_OP8,
    "op9_quality_rules": ORACLE_OP9,
    "op11_fill_in_middle": ORACLE_OP11,
    "op13_merkle_manifest": ORACLE_OP13,
}
