"""Queries registered for the driver, all over the given tables."""

from workloads import gate_queries, load_queries, risk_queries, semantic_queries, text_queries

REGISTRY = {
    **risk_queries.QUERIES,
    **gate_queries.QUERIES,
    **load_queries.QUERIES,
    **text_queries.QUERIES,
    **semantic_queries.QUERIES,
}
