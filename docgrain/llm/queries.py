"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from docgrain.llm import chat, decontaminate, jaccard, lines, mixing, neighbours, quality, repair, secrets, sharding, simhash, substrings, whitening


def queries() -> dict:
    return {
        "op1_line_runs": lines.op1_line_runs,
        "op2_secret_scan": secrets.op2_secret_scan,
        "op3_jaccard_join": jaccard.op3_jaccard_join,
        "op4_decontaminate": decontaminate.op4_decontaminate,
        "op5_repeated_substrings": substrings.op5_repeated_substrings,
        "op6_pivotal_mixing": mixing.op6_pivotal_mixing,
        "op7_quality_pu": quality.op7_quality_pu,
        "op8_feistel_sharding": sharding.op8_feistel_sharding,
        "op9_hilbert_neighbours": neighbours.op9_hilbert_neighbours,
        "op10_chat_format": chat.op10_chat_format,
        "op11_qdwh_whitening": whitening.op11_qdwh_whitening,
        "op12_conversation_repair": repair.op12_conversation_repair,
        "op13_simhash_golay": simhash.op13_simhash_golay,
    }


def oracle_sql() -> dict:
    return {"op1_line_runs": lines.OP1_SQL, "op4_decontaminate": decontaminate.OP4_SQL, "op5_repeated_substrings": substrings.OP5_SQL, "op10_chat_format": chat.OP10_SQL, "op12_conversation_repair": repair.OP12_SQL}
