"""Queries of this subpackage and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from . import bpe, exact_dedup, fuzzy_lines, hmm, hyperminhash, jaccard_join, manifest, merkle, mixing, pii, recompression, resampling, toxicity

QUERIES = {
    "op1_hmm": hmm.op1_hmm,
    "op2_pii": pii.op2_pii,
    "op3_mixing": mixing.op3_mixing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_bpe": bpe.op5_bpe,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_merkle": merkle.op7_merkle,
    "op8_recompression": recompression.op8_recompression,
    "op9_fuzzy_lines": fuzzy_lines.op9_fuzzy_lines,
    "op10_jaccard": jaccard_join.op10_jaccard,
    "op11_manifest": manifest.op11_manifest,
    "op12_resampling": resampling.op12_resampling,
    "op13_hyperminhash": hyperminhash.op13_hyperminhash,
}
#: Model scores, fits, fingerprints and vocabularies have no SQL form; those queries are tested by brute force.
ORACLES = {
    "op6_exact_dedup": exact_dedup.SQL,
    "op8_recompression": recompression.SQL,
    "op10_jaccard": jaccard_join.SQL,
    "op11_manifest": manifest.SQL,
    "op12_resampling": resampling.SQL,
    "op13_hyperminhash": hyperminhash.SQL,
}
