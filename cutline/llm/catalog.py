"""Registered queries of this folder and their SQL."""

from cutline.llm import (
    bestfit_packing, byte_bpe, conversation_repair, exact_dedup, jaccard_join, language_id, lattice_dedup, line_dedup,
    packing, periodic_runs, quality, secret_scan, token_counts,
)


def all_queries():
    return {
        "op1_language_id": language_id.op1_language_id,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_lattice_dedup": lattice_dedup.op3_lattice_dedup,
        "op4_secret_scan": secret_scan.op4_secret_scan,
        "op5_token_counts": token_counts.op5_token_counts,
        "op6_line_dedup": line_dedup.op6_line_dedup,
        "op7_quality_classifier": quality.op7_quality_classifier,
        "op8_jaccard_join": jaccard_join.op8_jaccard_join,
        "op9_byte_bpe": byte_bpe.op9_byte_bpe,
        "op10_packing": packing.op10_packing,
        "op11_conversation_repair": conversation_repair.op11_conversation_repair,
        "op12_bestfit_packing": bestfit_packing.op12_bestfit_packing,
        "op13_periodic_runs": periodic_runs.op13_periodic_runs,
    }


def all_sql():
    """What SQL can say: the dedups and the joins. The others are tested against plain versions."""
    return {
        "op2_exact_dedup": exact_dedup.OP2_SQL,
        "op3_lattice_dedup": lattice_dedup.OP3_SQL,
        "op6_line_dedup": line_dedup.OP6_SQL,
        "op8_jaccard_join": jaccard_join.OP8_SQL,
    }
