"""The queries of this subpackage; corpus_pipeline.py at the top of the repository belongs to it."""

from __future__ import annotations

from functools import wraps

import corpus_pipeline
from folio.llm import op01_language, op02_packing, op03_substrings, op04_quality, op05_mixing, op06_minhash, op07_embeddings, op08_secrets, op09_tokens, op10_neighbours, op11_conversations, op12_alignment, op13_suffixes
from folio.llm.common import small_batches


def tuned(f):
    """f in a session with small Arrow batches."""

    @wraps(f)
    def run(spark, sf_dir):
        small_batches(spark)
        return f(spark, sf_dir)

    return run


def queries() -> dict:
    every = {
        "op1_language": op01_language.op1_language,
        "op2_packing": op02_packing.op2_packing,
        "op3_substrings": op03_substrings.op3_substrings,
        "op4_quality": op04_quality.op4_quality,
        "op5_mixing": op05_mixing.op5_mixing,
        "op6_minhash": op06_minhash.op6_minhash,
        "op7_embeddings": op07_embeddings.op7_embeddings,
        "op8_secrets": op08_secrets.op8_secrets,
        "op9_tokens": op09_tokens.op9_tokens,
        "op10_neighbours": op10_neighbours.op10_neighbours,
        "op11_conversations": op11_conversations.op11_conversations,
        "op12_alignment": op12_alignment.op12_alignment,
        "op13_suffixes": op13_suffixes.op13_suffixes,
        "pipeline": corpus_pipeline.run,
    }
    return {name: tuned(f) for name, f in every.items()}


def oracle_sql() -> dict[str, str]:
    return {"op5_mixing": op05_mixing.SQL, "op6_minhash": op06_minhash.SQL, "op7_embeddings": op07_embeddings.SQL, "op11_conversations": op11_conversations.SQL, "op13_suffixes": op13_suffixes.SQL}
