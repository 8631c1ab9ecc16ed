"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from wardline.llm import bpe, classifier, exact_dedup, jaccard, licenses, packing, pii, rules, suffix, token_scan

QUERIES = {
    "op1_packing": packing.query,
    "op2_exact_dedup": exact_dedup.query,
    "op3_quality_classifier": classifier.query,
    "op4_ngram_jaccard": jaccard.query,
    "op5_licenses": licenses.query,
    "op6_token_counts": token_scan.query,
    "op7_pii": pii.query,
    "op8_bpe": bpe.query,
    "op9_suffix_dedup": suffix.query,
    "op10_quality_rules": rules.query,
}

SQL = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op5_licenses": licenses.SQL,
}
