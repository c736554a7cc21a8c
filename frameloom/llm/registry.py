"""The queries of this subpackage, by name."""

from __future__ import annotations

from frameloom.llm import bpe, embedding_dedup, exact_dedup, filter_audit, importance, language, mixing, packing, repeats, sharding, simhash, toxicity, warc


def queries() -> dict:
    return {
        "op1_language_id": language.op1_language_id,
        "op2_simhash": simhash.op2_simhash,
        "op3_mixing": mixing.op3_mixing,
        "op4_sharding": sharding.op4_sharding,
        "op5_embedding_dedup": embedding_dedup.op5_embedding_dedup,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_repeats": repeats.op7_repeats,
        "op8_warc": warc.op8_warc,
        "op9_exact_dedup": exact_dedup.op9_exact_dedup,
        "op10_packing": packing.op10_packing,
        "op11_filter_audit": filter_audit.op11_filter_audit,
        "op12_bpe": bpe.op12_bpe,
        "op13_importance": importance.op13_importance,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_sharding": sharding.OP4_SQL, "op8_warc": warc.OP8_SQL, "op9_exact_dedup": exact_dedup.OP9_SQL, "op11_filter_audit": filter_audit.OP11_SQL}
