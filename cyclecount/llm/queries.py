"""The registered queries of the training-data operators, and their DuckDB twins."""

from __future__ import annotations

from cyclecount.llm import arrow_ids, iblt, knn, lattice, lm, merkle, mixing, packing, projections, quality, runlength, secrets, simhash

REGISTRY = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_paragraph_sketches": iblt.op2_paragraph_sketches,
    "op3_quality_scores": quality.op3_quality_scores,
    "op4_arrow_ids": arrow_ids.op4_arrow_ids,
    "op5_language_model": lm.op5_language_model,
    "op6_simhash_groups": simhash.op6_simhash_groups,
    "op7_secret_scan": secrets.op7_secret_scan,
    "op8_repeated_passages": runlength.op8_repeated_passages,
    "op9_pack_sequences": packing.op9_pack_sequences,
    "op10_top_k": knn.op10_top_k,
    "op11_filter_audit": lattice.op11_filter_audit,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_nearest_vectors": projections.op13_nearest_vectors,
}

ORACLE = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op10_top_k": knn.OP10_SQL,
    "op11_filter_audit": lattice.OP11_SQL,
    "op12_merkle_manifest": merkle.OP12_SQL,
}
