"""Registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from memberlytics.llm import decontamination, lines, manifest, runs, substring
from memberlytics.llm.credentials import op3_secret_scan
from memberlytics.llm.neighbours import op7_nearest_neighbours
from memberlytics.llm.packing import op1_best_fit_packing
from memberlytics.llm.pii import op10_pii
from memberlytics.llm.repair import op4_token_ids
from memberlytics.llm.rules import op12_quality_rules
from memberlytics.llm.simhash import op8_simhash
from memberlytics.llm.toxicity import op6_toxicity

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_line_dedup": lines.op2_line_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_token_ids": op4_token_ids,
    "op5_substring_dedup": substring.op5_substring_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_simhash": op8_simhash,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_pii": op10_pii,
    "op11_periodic_runs": runs.op11_periodic_runs,
    "op12_quality_rules": op12_quality_rules,
    "op13_merkle_manifest": manifest.op13_merkle_manifest,
}
ORACLES: dict[str, str] = {
    "op2_line_dedup": lines.ORACLE,
    "op5_substring_dedup": substring.ORACLE,
    "op9_decontamination": decontamination.ORACLE,
    "op11_periodic_runs": runs.ORACLE,
    "op13_merkle_manifest": manifest.ORACLE,
}
