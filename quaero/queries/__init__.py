"""Registered queries: name -> (query, SQL with the same result, or None)."""

from quaero.queries import (
    cache_queries, dataset_queries, ingest_queries, retrieval_queries, stream_queries, text_queries,
)

REGISTRY = {
    **text_queries.QUERIES,
    **retrieval_queries.QUERIES,
    **cache_queries.QUERIES,
    **dataset_queries.QUERIES,
    **ingest_queries.QUERIES,
    **stream_queries.QUERIES,
}
