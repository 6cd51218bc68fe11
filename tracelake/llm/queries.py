"""Queries of this subpackage, by name; SQL where it can state the operator."""

from __future__ import annotations

from tracelake.llm import conversations, leakage, packing, pairs, shared_spans, truncation

QUERIES = {
    "p1_found": pairs.p1_found,
    "p1_rates": pairs.p1_rates,
    "p2_found": conversations.p2_found,
    "p2_conversations": conversations.p2_conversations,
    "p3_found": truncation.p3_found,
    "p3_rates": truncation.p3_rates,
    "p5_packed": packing.p5_packed,
    "p5_fill": packing.p5_fill,
    "p6_found": leakage.p6_found,
    "p6_spans": leakage.p6_spans,
    "p6_removals": leakage.p6_removals,
    "p7_found": shared_spans.p7_found,
    "p7_shares": shared_spans.p7_shares,
}

SQL: dict[str, str] = {}
