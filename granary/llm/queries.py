"""Registered queries of this subpackage and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from granary.llm import budget, encode, handwritten, mixing, neardup, pairs, reading, split


def queries():
    return {
        "p1_found": pairs.p1_found,
        "p1_pairs": pairs.p1_pairs,
        "p2_found": handwritten.p2_found,
        "p2_files": handwritten.p2_files,
        "p3_found": split.p3_found,
        "p3_pieces": split.p3_pieces,
        "p4_found": neardup.p4_found,
        "p4_groups": neardup.p4_groups,
        "p5_chunks": budget.p5_chunks,
        "p5_budget": budget.p5_budget,
        "p5_domains": budget.p5_domains,
        "p5_counts": budget.p5_counts,
        "p5_errors": budget.p5_errors,
        "p6_ids": encode.p6_ids,
        "p7_shares": mixing.p7_shares,
        "p7_copies": mixing.p7_copies,
        "p7_gaps": mixing.p7_gaps,
        "p8_found": reading.p8_found,
        "p8_levels": reading.p8_levels,
    }


def oracle_sql():
    return {"p3_found": split.P3_FOUND_SQL, "p4_found": neardup.P4_FOUND_SQL, "p5_counts": budget.P5_COUNTS_SQL}
