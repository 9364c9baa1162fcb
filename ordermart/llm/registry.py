"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from ordermart.llm import classifier, exact, fim, langid, lattice, lm, mixing, packing, pii, rules, simhash, urls, vafile

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_pii": pii.op2_pii,
    "op3_packing": packing.op3_packing,
    "op4_quality_rules": rules.op4_quality_rules,
    "op5_quality_classifier": classifier.op5_quality_classifier,
    "op6_language_id": langid.op6_language_id,
    "op7_url_filters": urls.op7_url_filters,
    "op8_lm_scoring": lm.op8_lm_scoring,
    "op9_simhash_near_dedup": simhash.op9_simhash_near_dedup,
    "op10_exact_dedup": exact.op10_exact_dedup,
    "op11_centroid_clustering": vafile.op11_centroid_clustering,
    "op12_fill_in_middle": fim.op12_fill_in_middle,
    "op13_embedding_near_dedup": lattice.op13_embedding_near_dedup,
}
ORACLE = {
    "op4_quality_rules": rules.ORACLE,
    "op10_exact_dedup": exact.ORACLE,
    "op11_centroid_clustering": vafile.ORACLE,
    "op12_fill_in_middle": fim.ORACLE,
}
