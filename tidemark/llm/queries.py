"""The operators' queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from tidemark.llm import (
    bpe, embeddings, exact_dedup, line_dedup, packing, quality, secrets, simhash, spelling, token_counts, token_files, toxicity,
    whitening)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_bpe": bpe.op3_bpe,
    "op4_quality": quality.op4_quality,
    "op5_secrets": secrets.op5_secrets,
    "op6_simhash": simhash.op6_simhash,
    "op7_packing": packing.op7_packing,
    "op8_embeddings": embeddings.op8_embeddings,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_spelling": spelling.op11_spelling,
    "op12_whitening": whitening.op12_whitening,
    "op13_token_files": token_files.op13_token_files,
}

SQL = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op2_line_dedup": line_dedup.SQL,
}
