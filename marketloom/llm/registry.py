"""The queries of this package and, where SQL can say the same, their DuckDB counterparts."""

from __future__ import annotations

from importlib import import_module

# query name: (module, function); a module may hold ORACLE_SQL for its query
OPERATORS = {
    "op1_kd_tree": "topk",
    "op2_toxicity": "toxicity",
    "op3_line_dedup": "line_dedup",
    "op4_byte_bpe": "bpe",
    "op5_setsketch": "near_dedup",
    "op6_mixing": "mixing",
    "op7_suffix_array": "repeats",
    "op8_secrets": "secrets",
    "op9_exact_dedup": "exact_dedup",
    "op10_warc": "warc",
    "op11_vector_packing": "packing",
    "op12_periodic_runs": "periodic",
    "op13_merkle_manifest": "manifest",
}


def load():
    """(queries, oracle SQL) by name."""
    import corpus_pipeline

    queries, oracles = {"pipeline": corpus_pipeline.run}, {}
    if corpus_pipeline.ORACLE_SQL:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    for name, place in OPERATORS.items():
        module = import_module(f"marketloom.llm.{place}")
        queries[name] = getattr(module, name)
        if getattr(module, "ORACLE_SQL", None):
            oracles[name] = module.ORACLE_SQL
    return queries, oracles
